"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame only.

Every source is dealt into blocks by a hash of its documents. A source's quota is all its blocks, once for each full
pass that the target needs, and, for the last, partial pass, permuted blocks as long as they fit. What
is then still missing is drawn in further rounds from documents that fit it, again in permuted groups whose
size falls from round to round, and at last in single documents: the largest that fits, again and again, and the
one that comes nearest to the rest. The blocks' quotas
go down a binary tree: each node deals a uniformly random half of its blocks to either child, so the
counts by source follow the multivariate hypergeometric law, blocks stay disjoint and quotas exact. A leaf
is an output shard; documents are shuffled inside it by a hash key.

The tree's draws are read off one random permutation of all quota blocks: a node holds a run of it, and its
children the halves of that run, which is the same law as drawing anew at each node.

Targets: a source's share of all sizes follows its weight; a target stops at max_repeat times the
source's size and the excess is shared anew by weight until none is above.

Scale: documents meet only small tables (a row a source, a row for each block of a source) and are never gathered by
source. A window holds at most one source's blocks, a hash group of the permutation, or a row for each range of a
sort. Which documents a round draws is told by one number a source (the end of its permuted groups), so
no list of documents is kept. Decisions depend on ids and texts alone, not on where a row lies.

Defined cases: null text: size 0, taken never; null source: a source of its own, last in order;
null id: told apart by its text; repeated rows (equal id, text and source): drawn together; all sizes 0: targets 0,
nothing taken; empty table: empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from factloom.llm.common import cut, drop_cut, pick

KEY = ["skey", "snull"]
#: Parts that a source's rows are dealt into where they meet its one row.
SALTS = 16


@dataclass(frozen=True)
class MixParams:
    """weights repeat over the sources in code point order; there are 2 ** depth shards, and a task
    writes about shard_words words of one. blocks: of each source, and groups of each further round; singles:
    documents that are chosen one by one at the end."""

    weights: tuple[int, ...] = (1, 2, 3)
    max_repeat: int = 3
    depth: int = 4
    blocks: int = 256
    rounds: int = 4
    singles: int = 3
    shard_words: int = 2_000_000
    seed: int = 17


def words(text: Column) -> Column:
    """Number of words, runs of other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame, p: MixParams, *more: Column) -> DataFrame:
    """Per row: id, th (hash of the text), skey and snull (the source), size, salt, and whatever more holds. docs: id, text, source."""
    return docs.select(
        F.col("id").cast("long").alias("id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.coalesce("source", F.lit("")).alias("skey"),
        F.col("source").isNull().alias("snull"),
        words(F.col("text")).alias("size"),
        *more,
    ).withColumn("salt", F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int"))


def of_source(rows: DataFrame, state: DataFrame) -> DataFrame:
    """rows with the columns of their source's one row; a hot source meets copies of it."""
    return rows.join(state.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*KEY, "salt"]).drop("salt")


def group(p: MixParams, r: int) -> Column:
    """The group that a document is in in round r; round 0 are the blocks."""
    return F.pmod(F.xxhash64(F.lit(p.seed + 31 * r), "id", "th"), F.lit(p.blocks))


def permuted(p: MixParams, r: int, of: Column) -> Column:
    """The place of a group in its source's permutation of round r."""
    return F.xxhash64(F.lit(p.seed + 31 * r + 7), "skey", "snull", of)


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """df with rank, from 0, in the order of the columns: ranges are counted, then each ranks its own rows."""
    parts = cut(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    before = F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(before, F.lit(0)).alias("start"))
    return parts.join(starts, "range").withColumn("rank", F.col("start") + F.row_number().over(W.partitionBy("range").orderBy(*order)) - 1).drop("range", "start")


def targets(rows: DataFrame, p: MixParams) -> DataFrame:
    """Per source: source_size and target."""
    src = ranked(rows.groupBy(*KEY).agg(F.sum("size").alias("source_size")), "snull", "skey")
    weight = F.element_at(F.array(*map(F.lit, p.weights)), (F.col("rank") % len(p.weights) + 1).cast("int"))
    src = cut(src.select(*KEY, "source_size", weight.cast("long").alias("weight")), "mix-sources")
    cap = F.col("source_size") * p.max_repeat
    total, weights = src.agg(F.sum("source_size"), F.sum("weight")).first()
    # whole sums of those below the level and above it; each round puts more of them at their cap
    over, level = (0, 0), 0.0
    while total and over[1] < weights:
        level = (total - over[0]) / (weights - over[1])
        now = src.where(cap <= F.col("weight") * F.lit(level)).agg(F.coalesce(F.sum(cap), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        if tuple(now) == over:
            break
        over = tuple(now)
    return src.select(*KEY, "source_size", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def draws_of_round(p: MixParams, r: int) -> Column:
    """Whether round r takes a document, by its source's gap and last place in that round."""
    return (F.col("size") > 0) & (F.col("size") <= F.col(f"gap{r}")) & (permuted(p, r, group(p, r)) <= F.col(f"last{r}"))


def drawn(p: MixParams, rounds: int) -> Column:
    """Whether one of the first rounds of the partial pass takes a document."""
    out = F.lit(False)
    for r in range(rounds):
        out = out | F.coalesce(draws_of_round(p, r), F.lit(False))
    return out


def number(p: MixParams) -> Column:
    """A document's own number in the choice of single ones."""
    return F.xxhash64(F.lit(p.seed + 99), "id", "th")


def extra(p: MixParams, singles: int) -> Column:
    """Whether the partial pass takes a document, by its rounds and the first so many singles."""
    out = drawn(p, p.rounds)
    for k in range(singles):
        out = out | F.coalesce(F.col(f"single{k}") == number(p), F.lit(False))
    return out


def partial_pass(rows: DataFrame, src: DataFrame, p: MixParams) -> DataFrame:
    """src with base (full passes) and, for the partial one, gap and last of each round and the single documents' numbers.

    Each round takes groups in permuted order as long as they fit what is missing; only documents that fit count.
    """
    base = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(p.max_repeat))).otherwise(0).cast("long")
    state = src.withColumn("base", base).withColumn("gap0", F.col("target") - F.col("base") * F.col("source_size"))
    state = cut(state, "mix-state")
    for r in range(p.rounds):
        left = of_source(rows, state).where((F.col("size") > 0) & (F.col("size") <= F.col(f"gap{r}")) & ~drawn(p, r))
        groups = left.withColumn("g", group(p, r)).groupBy(*KEY, "g").agg(F.sum("size").alias("words"), F.any_value(f"gap{r}").alias("gap"))
        groups = groups.withColumn("at", permuted(p, r, F.col("g")))
        upto = F.sum("words").over(W.partitionBy(*KEY).orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow))
        taken = groups.withColumn("upto", upto).where("upto <= gap").groupBy(*KEY).agg(F.max("at").alias(f"last{r}"), F.max("upto").alias("taken"))
        new = cut(state.join(taken, KEY, "left").withColumn(f"gap{r + 1}", F.col(f"gap{r}") - F.coalesce("taken", F.lit(0))).drop("taken"), "mix-state")
        drop_cut(state)
        state = new
    state = state.withColumn("gap", F.col(f"gap{p.rounds}"))
    for k in range(p.singles):
        off = F.abs(F.col("size") - F.col("gap"))
        fits = F.col("size") <= F.col("gap") if k < p.singles - 1 else off < F.col("gap")
        one = F.min(F.struct(off.alias("off"), number(p).alias(f"single{k}"), "size"))
        best = of_source(rows, state).where((F.col("size") > 0) & fits & ~extra(p, k)).groupBy(*KEY).agg(one.alias("one")).select(*KEY, f"one.single{k}", F.col("one.size").alias("taken"))
        new = cut(state.join(best, KEY, "left").withColumn("gap", F.col("gap") - F.coalesce("taken", F.lit(0))).drop("taken"), "mix-state")
        state = new
    return state


def split(tokens: DataFrame, p: MixParams) -> DataFrame:
    """The tree: tokens (skey, snull, block, pass) with the leaf (shard) each of them reaches.

    A node's run of the permutation is lo..hi; its left child has the first half, and an odd token goes to the side
    that the node's own number decides.
    """
    out = ranked(tokens.withColumn("draw", F.xxhash64(F.lit(p.seed + 1), "skey", "snull", "block", "pass")), "draw", "skey", "snull", "block", "pass")
    out = out.withColumns({"lo": F.lit(0).cast("long"), "hi": F.lit(out.count()).cast("long"), "node": F.lit(1).cast("long")})
    for _ in range(p.depth):
        odd = F.pmod(F.xxhash64(F.lit(p.seed), "node"), F.lit(2))
        middle = F.col("lo") + F.floor((F.col("hi") - F.col("lo") + odd) / 2)
        right = F.col("rank") >= middle
        out = out.withColumns({"node": F.col("node") * 2 + right.cast("long"), "lo": F.when(right, middle).otherwise(F.col("lo")), "hi": F.when(right, F.col("hi")).otherwise(middle)})
    return out.withColumn("shard", (F.col("node") - 2**p.depth).cast("int")).select("skey", "snull", "block", "pass", "shard")


def plan(rows: DataFrame, p: MixParams) -> tuple[DataFrame, DataFrame]:
    """(a row a source: source_size, target and the partial pass; a row a block: leaves, its passes with their shards)."""
    src = cut(targets(rows, p), "mix-targets")
    state = partial_pass(rows, src, p)
    known = of_source(rows, state).withColumn("extra", extra(p, p.singles))
    quota = known.groupBy(*KEY, group(p, 0).alias("block")).agg(F.any_value("base").alias("base"), F.max("extra").alias("extra"))
    passes = F.col("base") + F.col("extra").cast("long")
    tokens = quota.where(passes > 0).select(*KEY, "block", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1)).alias("pass"))
    leaves = split(tokens, p).groupBy(*KEY, "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("leaves"))
    return state, cut(leaves, "mix-leaves")


def placed(rows: DataFrame, state: DataFrame, leaves: DataFrame, p: MixParams) -> DataFrame:
    """rows with source_size, target and draws (array of pass, shard, place), by joins with the two small tables."""
    out = of_source(rows, state).withColumn("block", group(p, 0))
    out = out.withColumn("extra", extra(p, p.singles)).join(leaves, [*KEY, "block"], "left")
    place = lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), F.xxhash64(F.lit(p.seed), d["shard"], d["pass"], "id", "th").alias("place"))
    kept = F.filter("leaves", lambda d: (F.col("size") > 0) & ((d["pass"] < F.col("base")) | F.col("extra")))
    none = F.array().cast("array<struct<pass:bigint,shard:int,place:bigint>>")
    return out.withColumn("draws", F.coalesce(F.transform(kept, place), none))


def mix(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per input row: doc_id, source, size, source_size, target, draws (array of pass, shard, place).

    The mixture is the exploded draws; place orders a shard's documents.
    """
    rows = cut(sized(pick(docs, id=id_col, text=text_col, source=source_col), params), "mix-sizes")
    out = placed(rows, *plan(rows, params), params)
    return out.select(F.col("id").alias("doc_id"), F.when(~F.col("snull"), F.col("skey")).alias("source"), "size", "source_size", "target", "draws")


def digest(mixed: DataFrame) -> DataFrame:
    """The contract's columns, the words counted over the draws, and where each draw goes."""
    text = F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["pass"].cast("string"), d["shard"].cast("string"), d["place"].cast("string"))), ",")
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), text.alias("draws"))


def mixture(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """documents as the mixture takes them: a row for each draw, shards together, shuffled inside.

    A shard beyond shard_words goes out in parts by its random order, so a task's share of the output
    doesn't grow with the corpus. Columns unchanged; a row travels as one struct, so its names can't clash.
    """
    columns, p = docs.columns, params
    named = docs.select(F.col("doc_id").alias("id"), "text", "source", F.struct(*columns).alias("doc"))
    rows = cut(sized(named, p), "mix-sizes")
    state, leaves = plan(rows, p)
    wanted = state.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    parts = max(1, -(-int(wanted) // (2**p.depth * p.shard_words)))
    out = placed(sized(named, p, F.col("doc")), state, leaves, p).select("doc", F.explode("draws").alias("d"))
    out = out.select("doc", F.col("d")["shard"].alias("shard"), F.pmod(F.col("d")["place"], F.lit(parts)).alias("part"), F.col("d")["place"].alias("place"))
    out = out.repartition("shard", "part").sortWithinPartitions("shard", "part", "place")
    return out.select(*[F.col("doc")[c].alias(c) for c in columns])
