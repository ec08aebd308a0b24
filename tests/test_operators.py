"""Laws and small cases of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from factloom.operators import best, guards, history, merge, ranks, relate, resolve
from factloom.operators.profile import Profile
from factloom.plans import queries


def test_merge_laws(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(6), s, rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])) for s in range(60)]
    rules = {"a": "first", "b": "union"}
    of = lambda r: sorted(map(tuple, merge.merge_observations(spark.createDataFrame(r, "id int, seq int, a int, b string"), ["id"], ["seq"], rules).drop("observations").collect()))
    once = of(rows)
    assert of(rows + rows) == once
    rng.shuffle(rows)
    assert of(rows) == once
    for i, a, b, clash, names in once:
        known = [r[2] for r in sorted(rows, key=lambda r: r[1]) if r[0] == i and r[2] is not None]
        assert a == (known[0] if known else None)
        assert b == ",".join(sorted({r[3] for r in rows if r[0] == i and r[3]}))
        assert clash == (len(set(known)) > 1) and names == ("a" if clash else "")


def test_contradicting_rows_give_evidence_only(spark):
    df = spark.createDataFrame([(1, 1, None, "a"), (1, 2, 5, "b"), (1, 3, 6, "c"), (2, 1, None, "z")], "id int, seq int, v int, e string")
    assert sorted(map(tuple, merge.fold_in_order(df, ["id"], ["seq"], "v", "e").collect())) == [(1, 5, "a,b,c", 1), (2, None, "z", 0)]


def test_best_ties_and_unknown_dates(spark):
    df = spark.createDataFrame([("k", 10, None, 1), ("k", 10, "2020", 2), ("k", 10, "2020", 3), ("k", 9, "2019", 4)], "key string, v int, d string, id int")
    assert best.best_per_key(df, ["key"], "v", True, "d", ["id"], []).first().id == 2
    assert best.best_per_key(df, ["key"], "v", False, "d", ["id"], []).first().id == 4
    assert sorted((r.best, r.id) for r in best.tied_ids(df, ["key"], "v", True, "id").collect()) == [(10, 1), (10, 2), (10, 3)]


def test_contested_context_has_no_candidate(spark):
    df = spark.createDataFrame([("k", "c1", 1), ("k", "c1", 2), ("k", "c2", 9)], "key string, ctx string, v int")
    settled, contested = best.split_contested(df, ["key"], ["ctx"], "v")
    assert [r.v for r in settled.collect()] == [9] and [r.ctx for r in contested.collect()] == ["c1"]


def test_components_chain_star_cycle(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(1, k) for k in range(2, 9)] + [(20, 21), (21, 22), (22, 20)] + [(7, 7)]
    got = dict(map(tuple, resolve.components(spark.createDataFrame(edges, "a int, b int")).select("v", "label").collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(1, 9)} == {1} and {got[i] for i in (20, 21, 22)} == {20}
    assert resolve.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_redirects(spark):
    links = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("m", "n1"), ("m", "n2"), ("q", "m")]
    got = {r.id: (r.canonical, r.outcome) for r in resolve.redirects(spark.createDataFrame(links, "src string, dst string")).collect()}
    assert got["a"] == ("c", "canonical") and got["b"] == ("c", "canonical")
    assert got["x"][1] == got["y"][1] == "cyclic" and got["m"][1] == got["q"][1] == "ambiguous"


def test_diff_scope_and_multiset(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "k int, f string")
    b = spark.createDataFrame([(2, None), (3, "y"), (4, "w")], "k int, f string")
    assert sorted(map(tuple, relate.snapshot_diff(a, b, ["k"], ["f"]).collect())) == [(1, "removed", ""), (3, "modified", "f"), (4, "added", "")]
    inside, outside = relate.split_scope(a, a.f == "x")
    assert (inside.count(), outside.count()) == (1, 2)
    assert sorted(map(tuple, relate.multiset_diff(a.select("k").union(a.select("k")), a.select("k"), ["k"]).collect())) == [(1, 1, 0), (2, 1, 0), (3, 1, 0)]


def test_as_of_and_intervals(spark):
    facts = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("b", 3, 9)], "k string, id int, at int")
    versions = spark.createDataFrame([("a", 2, "v2"), ("a", 5, "v5"), ("a", 6, "v6")], "k string, since int, v string")
    assert {r.id: r.v for r in relate.as_of(facts, versions, ["k"], "at", "since", ["v"]).collect()} == {1: "v5", 2: None, 3: None}
    windows = spark.createDataFrame([("a", 1, 5, "r"), ("a", 5, 5, "s")], "k string, f int, l int, rule string")
    assert sorted((r.id, r.rule) for r in relate.interval_join(facts, windows, ["k"], "at", "f", "l").collect()) == [(1, "r"), (1, "s"), (2, "r")]


def test_unique_match_never_multiplies(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    right = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "p int, id int")
    assert sorted((r.p, r.outcome, r.match) for r in relate.unique_match(left, right, ["p"], "id").collect()) == [(1, "unique", 10), (2, "ambiguous", None), (3, "absent", None)]


def test_guards_refuse(spark):
    df = spark.range(10)
    assert guards.within_rows(df, 10).count() == 10
    with pytest.raises(Exception):
        guards.within_rows(df, 9).count()
    kept, refused = guards.refuse_groups(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"], 1)
    assert [r.k for r in kept.collect()] == [2] and [(r.k, r["size"]) for r in refused.collect()] == [(1, 2)]


def test_identity_replay(spark):
    rows = [(1, "merge", 1, 2), (2, "merge", 3, 2), (3, "split", 2, 3), (4, "merge", 7, 5), (5, "revoke", 5, 7), (6, "merge", 5, 7)]
    got = {r.id: r.canonical for r in history.replay(spark.createDataFrame(rows, "seq int, kind string, a int, b int")).collect()}
    assert got == {1: 1, 2: 1, 5: 5, 7: 5}


def test_ranks_in_a_group_that_spans_ranges(spark):
    rows = [("hot" if i % 4 else None, i) for i in range(4000)] + [("b", 1)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(5)
    got = ranks.numbered(df, ["g"], ["i"]).collect()
    for g in ("hot", None, "b"):
        mine = sorted((r.i, r["rank"]) for r in got if r.g == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1)) and len(mine) == sum(x == g for x, _ in rows)


def test_conflicts_count_known_values(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, "a", None), (2, None, 3), (2, "x", 4), (2, "x", 5)], "id int, s string, n int")
    assert sorted(map(tuple, merge.conflict_report(df, ["id"], ["s", "n"]).collect())) == [(1, "s", 2, "a", "b"), (2, "n", 3, "3", "5")]


def test_profile():
    assert Profile(places=("b", "a", "a")).id == Profile(places=("a", "b")).id != Profile(places=("a",)).id
    with pytest.raises(ValueError):
        Profile(first="2025-01-01", last="2024-01-01")


def test_pair_agreements_meet_in_tiles(spark):
    """Every pair once, over tiles of any evenness; equal and null ids are no pair, null values agree with nothing."""
    ids = [*range(40), 5, None, -(2**62), 2**62, 2**62 + 1]
    rows = [("k", i, None if n % 9 == 0 else n % 3) for n, i in enumerate(ids)] + [(None, 1, 1), (None, 2, 1), ("one", 1, 1)]
    want = sorted((a, b, None if u is None or v is None else u == v) for k, a, u in rows for m, b, v in rows if k and k == m and None not in (a, b) and a < b)
    for tile in (1, 7, 1000):
        got = relate.pair_agreements(spark.createDataFrame(rows, "k string, id long, v int"), ["k"], "id", {"same": "v"}, tile)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_pair_flags_keep_large_blocks(spark, tmp_path):
    """A block of 100,002 parts is paired whole; only its pairs with the first part are counted."""
    parts = spark.range(100_002).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"), F.lit("b").alias("p_brand"))
    parts.write.parquet(f"{tmp_path}/part.parquet")
    assert queries.queries()["pair_flags"](spark, str(tmp_path)).where("a = 0").count() == 100_001


def test_pair_agreements_share_out_pairs(spark):
    """A group's pairs lie in many tasks, though its bytes are few; texts agree as they do in SQL."""
    rows = spark.range(2000).select(F.lit("k").alias("k"), "id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("v"))
    pairs = relate.pair_agreements(rows, ["k"], "id", {"same": "v"}, 400)
    by_task = [n for _, n in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by_task) == 2000 * 1999 // 2
    assert max(by_task) < sum(by_task) / 3
    found = pairs.groupBy("same").agg(F.count("*"), F.sum("a"), F.sum("b"))
    plain = rows.alias("x").join(rows.alias("y"), F.expr("x.k = y.k and x.id < y.id")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.expr("x.v = y.v").alias("same"))
    assert sorted(found.collect(), key=repr) == sorted(plain.groupBy("same").agg(F.count("*"), F.sum("a"), F.sum("b")).collect(), key=repr)
