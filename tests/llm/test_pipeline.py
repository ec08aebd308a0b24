"""The pipeline's stages against brute force on a small table."""

import collections

import corpus_pipeline as P
from factloom.llm import neardup, quality, secrets
from factloom.llm.common import cut

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = cut(P.quality_stage(spark, docs, SF), "t")
    want = {r.doc_id for r in quality.score_quality(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns
    truth = {r.doc_id: r.quality for r in labels.collect()}
    clean = [i for i, q in truth.items() if q == 1]
    assert sum(i in want for i in clean) >= 0.97 * len(clean)

    unique = cut(P.neardup_stage(spark, good, SF), "t")
    sets = {}
    cache = neardup.WordHashes()
    for r in good.collect():
        sets[r.doc_id] = frozenset(neardup.shingle_set(r.text, 5, cache).tolist())
    kept = {r.doc_id for r in unique.collect()}
    for a in kept:
        for b in kept:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                assert 100 * n < 80 * (len(sets[a]) + len(sets[b]) - n)
    assert {frozenset(s) for s in sets.values()} >= {sets[i] for i in kept}

    safe = cut(P.secrets_stage(spark, unique, SF), "t")
    assert {r.doc_id for r in safe.collect()} == kept and safe.columns == docs.columns
    left = secrets.scan_secrets(safe).collect()
    assert not [s for r in left for s in r.spans if s["class"] == "live" and s["kind"] == "access"]

    mixed = cut(P.mixing_stage(spark, safe, SF), "t")
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and set(times) <= kept and max(times.values()) <= 3

    packed = P.packing_stage(spark, mixed, SF).collect()
    assert collections.Counter(r.doc_id for r in packed if r.piece == 0) == times


def test_run_applies_the_stages_in_order(spark):
    assert [name for name, _ in P.STAGES] == ["quality", "near-dedup", "secrets", "mixing", "packing"]
    assert P.ORACLE_SQL is None
    assert P.run(spark, SF).count() > 0


def test_run_on_an_empty_table_and_with_clashing_columns(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    docs.limit(0).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert P.run(spark, f"file://{tmp_path}").count() == 0
    names = ("id", "th", "key", "salt", "doc", "d", "place", "draws", "block", "live", "size", "z", "v", "comp")
    wide = docs.selectExpr("*", *[f"'x' as `{c}`" for c in names])
    wide.write.mode("overwrite").parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted(map(tuple, P.run(spark, f"file://{tmp_path}").select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    assert got == sorted(map(tuple, P.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) and got
