"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from factloom.llm import fingerprints, html_extract, media, mixing, neardup, packing, quality, secrets, toxicity, warc
from factloom.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, size string, th double, key string, __n int"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000
ROWS = [
    (1, None, "en", "a"),
    (2, "", None, "b"),
    (3, "one", "en", None),
    (4, "the cat sat on the mat and looked at the moon for a while", "en", "a"),
    (4, "the cat sat on the mat and looked at the moon for a while", "en", "a"),
    (5, "the cat sat on the mat and looked at the moon for a while", None, None),
    (6, LONG, "en", "a"),
    (None, "no id here but some words", "en", "z"),
]
LABELS = "doc_id long, quality int, toxic int, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", 1, "y", 0.5, "k", 2) for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0, ""), (4, 1, 0, ""), (5, 1, 1, ""), (6, None, None, ""), (None, 1, 1, ""), (4, 1, 0, "")], LABELS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


def test_near_duplicates(docs, empty):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert [g[2] for g in got if g[0] in (4, 5)] == [4, 4, 4]
    assert [g for g in got if g[0] in (1, 2)] == [(1, 0, 1, True), (2, 0, 2, True)]
    assert len(got) == len(ROWS)
    assert neardup.near_duplicates(empty).count() == 0
    twin = docs.where("doc_id = 4").limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    near = twin.withColumn("text", F.concat("text", F.lit(" again")))
    with_null = neardup.near_duplicates(docs.unionByName(twin).unionByName(near), neardup.NearDupParams(words=2, percent=60)).where("doc_id is null and n_shingles > 8").collect()
    assert [r.component_id for r in with_null] == [4, 4]
    kept = neardup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6]
    assert neardup.dedup(empty).count() == 0


def test_secrets(docs, empty):
    assert secrets.digest(secrets.scan_secrets(docs)).where("spans = ''").count() == len(ROWS)
    assert secrets.scan_secrets(empty).count() == 0
    assert sorted(r.text or "" for r in secrets.redact(docs).collect()) == sorted(r[1] or "" for r in ROWS)
    assert secrets.redact(empty).columns == docs.columns


def test_packing(docs, empty):
    got = packing.pack(docs, tokenizer_path()).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert [r.length for r in got if r.doc_id == 1] == [1]
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_mixing(docs, empty):
    got = mixing.digest(mixing.mix(docs)).collect()
    assert len(got) == len(ROWS)
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert mixing.mix(empty).count() == 0
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r.draws) for r in mixing.mix(docs).collect())
    assert mixing.mixture(empty).count() == 0


def test_quality(docs, empty, labels, no_labels):
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score_quality(docs, no_labels).collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0
    assert quality.keep_quality(docs, labels).columns == docs.columns


def test_conflicting_labels_of_equal_texts_and_repeated_ids(spark):
    """Equal texts score alike whatever their labels; of a repeated id, one label of 1 counts."""
    text = lambda i: ("Clean, long prose of a kind. " if i % 2 else "$$$ BUY!!! NOW### ") * 20 + str(i // 4)
    rows = [(i, text(i)) for i in range(200)] + [(500, text(1)), (501, text(1)), (3, text(3)), (3, text(4))]
    given = [(i, i % 2, 1 - i % 2) for i in range(200)] + [(500, 0, 1), (501, 1, 0), (3, 0, 1), (3, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    for scored in (quality.score_quality(frame, known), toxicity.score_toxicity(frame, known)):
        got = scored.collect()
        assert len(got) == len(rows)
        assert len({round(r.score, 9) for r in got if r.doc_id in (1, 500, 501)}) == 1
    held = [r for r in quality.score_quality(frame, known).collect() if r.doc_id < 200 and r.doc_id != 3]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.95 * len(held)


def test_labelled_texts_beyond_the_bag_bound_are_scored(spark):
    rows = [(i, ("Good words, well put. " if i % 2 else "@@@ ### ") * (4 if i else 4000)) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    got = quality.score_quality(frame, known, quality.QualityParams(max_bag=8)).collect()
    assert len(got) == 60 and all(0 <= r.score <= 1 for r in got)


def test_keep_quality_of_an_empty_table(empty, labels):
    assert quality.keep_quality(empty, labels).count() == 0


def test_mixing_without_words_and_with_ties(spark):
    none = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "  ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.digest(mixing.mix(none)).collect()] == [(0, 0.0, 0)] * 3
    assert mixing.mixture(none).count() == 0
    # sources 1 and 4 have equal weight and size, so an equal ratio of cap and weight
    rows = [(i, "w " * 10, f"s{i % 6}") for i in range(120)]
    got = mixing.digest(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    assert {(r.doc_id % 6, r.target) for r in got} == {(k, 1200 * (k % 3 + 1) / 12) for k in range(6)}
    taken = {k: sum(r.taken for r in got if r.doc_id % 6 == k) for k in range(6)}
    assert taken == {k: 1200 * (k % 3 + 1) / 12 for k in range(6)}


def test_mixing_tree_deals_exact_quotas(spark):
    p = mixing.MixParams(depth=3)
    rows = [(f"s{k}", False, b, n) for k, blocks in enumerate((40, 13, 1)) for b in range(blocks) for n in range(k + 1)]
    tokens = spark.createDataFrame(rows, "skey string, snull boolean, block long, pass long")
    totals, shares = [], []
    for seed in range(6):
        got = mixing.split(tokens, mixing.MixParams(depth=3, seed=seed)).collect()
        assert sorted((r.skey, r.snull, r.block, r["pass"]) for r in got) == sorted(rows)
        sizes = [sum(r.shard == s for r in got) for s in range(2**p.depth)]
        assert max(sizes) - min(sizes) <= p.depth and min(sizes) > 0
        totals.append(tuple(sizes))
        shares += [sum(r.shard == s and r.skey == "s0" for r in got) / 40 for s in range(8)]
    # a shard's share of a source: hypergeometric, mean 1/8, and not always the same
    assert abs(sum(shares) / len(shares) - 1 / 8) < 1e-9 and 0.02 < (sum((x - 1 / 8) ** 2 for x in shares) / len(shares)) ** 0.5 < 0.09


def test_long_pages(spark):
    body = "".join(f"<p>Paragraph {i}, which is long enough, with commas, to be read as text.</p>" for i in range(30_000))
    pages = spark.createDataFrame([(1, "u", f"<html><body><nav><a href=x>y</a></nav><article>{body}</article></body></html>")], "page_id long, url string, html string")
    got = html_extract.extract_main_text(pages).first()
    assert got.text.count("Paragraph") == 30_000 and got.n_chars == len(got.text)
    assert warc.round_trip(pages).first().payload_bytes == len(body) + len("<html><body><nav><a href=x>y</a></nav><article></article></body></html>")


def test_toxicity(docs, empty, labels, no_labels):
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == len(ROWS)
    assert toxicity.score_toxicity(docs, no_labels).count() == len(ROWS)
    assert toxicity.score_toxicity(empty, labels).count() == 0


def test_fingerprints(docs, empty):
    got = fingerprints.fingerprint_neighbours(docs).collect()
    assert len(got) == len(ROWS)
    assert len({r.fingerprint for r in got if r.doc_id in (4, 5)}) == 1
    assert fingerprints.fingerprint_neighbours(empty).count() == 0


def test_media(docs, empty):
    got = {r.doc_id: r for r in media.round_trip(docs).collect()}
    assert got[1].payload_bytes == 576 and got[1].n_bytes == 0
    assert got[6].payload_bytes >= len(LONG) and got[6].payload_bytes % 576 == 0
    assert media.round_trip(docs).count() == len(ROWS)
    assert media.round_trip(empty).count() == 0


PAGES = "page_id long, url string, html string, text string, digest string, capture int"


def test_pages(spark):
    rows = [(1, "http://a/x", None), (2, None, ""), (3, "http://a/y", "<p>" + "x" * 200), (2, "http://b", "<p>" + "x" * 200), (2, "http://b", "<p>" + "x" * 200), (None, "u", "<p>short"), (9, "u", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\nx " * 50)]
    pages = spark.createDataFrame([(*r, "t", "d", 1) for r in rows], PAGES)
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    assert [(r.record_type, r.refers_to) for r in got if r.page_id == 3] == [("revisit", 2)]
    assert all(r.has_request and r.has_metadata for r in got)
    assert [r.payload_bytes for r in got if r.page_id == 9] == [len(rows[-1][2])]
    none = spark.createDataFrame([], PAGES)
    assert warc.round_trip(none).count() == 0
    text = html_extract.extract_main_text(pages).collect()
    assert [r.text for r in text if r.page_id == 1] == [""]
    assert html_extract.extract_main_text(none).count() == 0
