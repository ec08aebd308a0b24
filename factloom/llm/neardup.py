"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

Each document is the set of its distinct k-word shingles. Rounds of hashed bin placement (a round
hashes every shingle to a bin and a value; round t + b sends every shingle to bin b) fill all t
coordinates of a sketch, and an early round always wins, so two sketches agree in a coordinate with
the probability of the Jaccard likeness, with concentration like t independent draws. A coordinate is kept as
one byte. Bands of the sketch propose candidates; every link is confirmed on whole shingle sets.

Work is kept near linear by classes and blocks. Documents with equal shingle sets are one node, and only
one row of them carries its text on. First, each node is held against one centre: of the least nodes of its band
keys the one that shares most keys with it. Then keys that still hold several components are searched: their
members are dealt into blocks, where members of the largest component meet only the others. A block
first tells from sketches which members have a candidate at all; only their texts travel on, and the block
verifies its candidates there, skipping those that a link found before has joined. So pairs never become
rows, and what leaves a block is at most a link for each member. No partner, bucket or block count is capped.

Hot keys: a centre's members are dealt by hash into groups of about `block`; joins on a class, a component or a
key are between written tables, where Spark may split a large partition. The joins that fetch texts are merge
joins at every size: what they meet grows with the corpus.

Defined cases: null or empty text, or text without words: empty set, linked with nothing, own
component. Fewer words than the shingle length: one shingle of all words. Repeated rows: equal sets,
one class. Repeated doc_id: each row is judged by its own text. Null doc_id: linked like others, never
the least of a component that has an id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from factloom.llm.common import cut, drop_cut, map_rows, pick, squeezed, unsqueezed

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)
LOW32 = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class NearDupParams:
    """words: shingle length; percent: least 100 * likeness; bands * rows coordinates in a sketch, at most 64 bands.

    slack: a pair whose share of equal sketch coordinates is below percent/100 - slack isn't
    verified (5.2 standard deviations at 252 coordinates and a likeness of 0.8). block: members of a
    group that one task holds.
    """

    words: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6
    slack: float = 0.13
    block: int = 320

    @property
    def t(self) -> int:
        return self.bands * self.rows


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, k: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = len(words) - k + 1
    acc = np.zeros(n, np.uint64)
    for i in range(k):
        acc = mix64(acc * GOLD + h[i : i + n] + np.uint64(i + 1))
    return np.unique(acc)


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """t coordinates, every one filled; elements: distinct uint64, at least one."""
    n = len(elements)
    rounds = min(t, max(1, int(np.ceil(1.2 * t * np.log(max(t, 2)) / n))))
    out, filled, start = np.zeros(t, np.uint64), np.zeros(t, bool), 0
    while start < t and not filled.all():
        r = np.arange(start, min(t, start + rounds), dtype=np.uint64)
        z = mix64(elements[None, :] + (r[:, None] + np.uint64(1)) * GOLD)
        bins = (z >> np.uint64(32)) % np.uint64(t)
        # order by bin, then round, then value; 16 + 16 + 32 bits
        c = np.sort(((bins << np.uint64(48)) | (r[:, None] << np.uint64(32)) | (z & LOW32)).ravel())
        b = (c >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        new = first[~filled[b[first]]]
        out[b[new]] = c[new] & np.uint64(0xFFFFFFFFFFFF)
        filled[b[new]] = True
        start += rounds
    for b in np.flatnonzero(~filled):
        z = mix64(elements + np.uint64(((t + int(b) + 1) * int(GOLD)) & (2**64 - 1)))
        out[b] = (np.uint64(t + b) << np.uint64(32)) | (z.min() & LOW32)
    return mix64(out)


LONGS = lambda *names: [T.StructField(c, T.LongType()) for c in names]
LINK = T.StructType(LONGS("a", "b"))


def features(docs: DataFrame, p: NearDupParams) -> DataFrame:
    """Per row: at (its own number), id, th (hash of the text), n, cid (digest of the set, null if empty).

    The first row of a class in a task also has sk (the sketch, a byte a coordinate) and z (its text, compressed).
    """
    schema = T.StructType([*LONGS("at", "id", "th", "n"), T.StructField("cid", T.BinaryType()), T.StructField("sk", T.BinaryType()), T.StructField("z", T.BinaryType())])

    def run(slices):
        cache, seen, at = WordHashes(), set(), TaskContext.get().partitionId() << 33
        for rows in slices:
            out = []
            for r in rows:
                s = shingle_set(r["text"], p.words, cache)
                cid = xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None
                lead = cid is not None and cid not in seen
                if lead:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(cid)
                out.append((at, r["id"], r["th"], len(s), cid, sketch(s, p.t).astype(np.uint8).tobytes() if lead else None, squeezed(r["text"]) if lead else None))
                at += 1
            yield out

    return map_rows(docs.withColumn("th", F.xxhash64(F.coalesce("text", F.lit("")))), run, schema)


def keys(p: NearDupParams) -> Column:
    """The band keys of column sk: hashes whose low 6 bits are the band's number."""
    band = lambda k: F.xxhash64(F.lit(k), F.substring("sk", k * p.rows + 1, p.rows))
    return F.explode(F.array(*[F.shiftleft(band(k), 6).bitwiseOR(F.lit(k)) for k in range(p.bands)])).alias("key")


def reaches(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """For each of the others whether its likeness to x, on whole sets, is at least percent."""
    sizes = np.array([len(o) for o in others])
    every = np.concatenate(others)
    hits = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    inter = np.add.reduceat(hits.astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
    return 100 * inter >= percent * (len(x) + sizes - inter)


def grouped(slices, names: tuple[str, ...]) -> Iterator[list[dict]]:
    """The rows of each run of equal values of names."""
    held: list[dict] = []
    for rows in slices:
        for r in rows:
            if held and any(r[c] != held[0][c] for c in names):
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def verify_stars(star: DataFrame, texts: DataFrame, p: NearDupParams) -> DataFrame:
    """The pairs (a, b) of star, a centre and a member, whose whole sets reach the threshold."""
    many = star.groupBy("a").agg(F.count("*").alias("m")).where(F.col("m") > p.block).select("a", F.ceil(F.col("m") / p.block).alias("nb"))
    dealt = star.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("nb", F.lit(1))).alias("blk"))
    centres = dealt.select("a", "blk").distinct().select(F.col("a").alias("v"), "a", "blk", F.lit(0).alias("member"))
    both = centres.unionByName(dealt.select(F.col("b").alias("v"), "a", "blk", F.lit(1).alias("member")))
    ordered = texts.join(both.hint("merge"), "v").repartition("a", "blk").sortWithinPartitions("a", "blk", "member")

    def run(slices):
        cache, centre = WordHashes(), None
        for rows in slices:
            out = []
            for r in rows:
                mine = shingle_set(unsqueezed(r["z"]), p.words, cache)
                if not r["member"]:
                    centre = mine
                elif reaches(centre, [mine], p.percent)[0]:
                    out.append((r["a"], r["v"]))
            yield out

    return map_rows(ordered, run, LINK)


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of a link: label is the least vertex reachable.

    Each round points every vertex at its least neighbour, shortens the pointers to their roots by
    doubling and contracts the links, so rounds grow with the logarithm of the longest chain.
    """
    edges = cut(links.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y").distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        point = cut(ends.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("v"), F.least("x", "m").alias("label")), "cc-point")
        while True:
            to = point.select(F.col("v").alias("label"), F.col("label").alias("next"))
            jumped = cut(point.join(to, "label").select("v", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "cc-jump")
            drop_cut(point)
            point = jumped
            if point.where("moved").isEmpty():
                break
        step = point.select(F.col("v").alias("label"), F.col("label").alias("root"))
        if labels is None:
            merged = point.select("v", "label")
        else:
            merged = labels.join(step, "label", "left").select("v", F.coalesce("root", "label").alias("label"))
        merged = cut(merged, "cc-labels")
        names = point.select("v", "label")
        contracted = edges.join(names.select(F.col("v").alias("x"), F.col("label").alias("lx")), "x").join(names.select(F.col("v").alias("y"), F.col("label").alias("ly")), "y")
        fewer = cut(contracted.where("lx <> ly").select(F.least("lx", "ly").alias("x"), F.greatest("lx", "ly").alias("y")).distinct(), "cc-edges")
        for old in [edges, point] + ([labels] if labels is not None else []):
            drop_cut(old)
        labels, edges = merged, fewer
    if labels is None:
        return edges.select(F.col("x").alias("v"), F.col("y").alias("label"))
    drop_cut(edges)
    return labels


def extended(labels: DataFrame, more: DataFrame) -> DataFrame:
    """labels with further links: only the components that the new links join are worked on."""
    of_a = labels.select(F.col("v").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
    ends = more.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    joined = components(ends)
    roots = joined.select(F.col("v").alias("label"), F.col("label").alias("root"))
    old = labels.join(roots, "label", "left").select("v", F.coalesce("root", "label").alias("label"))
    return cut(old.unionByName(joined.join(labels, "v", "left_anti")), "cc-labels")


def dealt_blocks(rows: DataFrame, p: NearDupParams) -> DataFrame:
    """rows (key, v, comp) of keys with several components, dealt: with blk and each pair of blocks (i, j) to meet in.

    A small key is one block. In others the largest component's members and the rest have blocks of their own, and
    no two blocks of the largest component meet.
    """
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("c"))
    size = per.groupBy("key").agg(F.sum("c").alias("m"), F.max("c").alias("most"), F.max_by("comp", "c").alias("large")).where("m > most")
    blocks = lambda n: F.ceil(n / F.lit(p.block)).cast("int")
    own, rest = blocks(F.col("most")), blocks(F.col("m") - F.col("most"))
    small = F.col("m") <= p.block
    size = size.select("key", "large", F.when(small, 0).otherwise(own).alias("nl"), F.when(small, 1).otherwise(rest).alias("no"))
    within = F.col("nl") == 0
    main = ~within & (F.col("comp") == F.col("large"))
    blk = F.when(main, F.col("no") + F.pmod(F.xxhash64("v"), F.greatest("nl", F.lit(1)))).otherwise(F.pmod(F.xxhash64("v"), F.col("no"))).cast("int")
    # the main component's blocks meet the others' only; those meet all
    upto = F.when(main, F.col("no")).otherwise(F.col("no") + F.col("nl")) - 1
    out = rows.join(size, "key").withColumn("blk", blk).withColumn("o", F.explode(F.sequence(F.lit(0), upto)))
    return out.select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "v", "comp")


class Candidates:
    """The candidate pairs of a group: rows of one key and pair of blocks.

    A pair is one of different components whose sizes and sketches allow the threshold; it belongs to the first
    band that the two share, so it is found once.
    """

    def __init__(self, group: list[dict], p: NearDupParams):
        i, j = group[0]["i"], group[0]["j"]
        self.left = [k for k, r in enumerate(group) if r["blk"] == i]
        self.right = np.array(self.left if i == j else [k for k, r in enumerate(group) if r["blk"] == j], np.int64)
        self.same_block, self.p, self.band = i == j, p, group[0]["key"] & 63
        ids = {c: k for k, c in enumerate({r["comp"] for r in group})}
        self.comp = np.array([ids[r["comp"]] for r in group])
        self.n = np.array([r["n"] for r in group])
        self.sk = np.frombuffer(b"".join(r["sk"] for r in group), np.uint8).reshape(len(group), p.t)
        self.least = int(np.ceil((p.percent / 100 - p.slack) * p.t))

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        """(row, its partners, likeliest first)."""
        p = self.p
        for at, k in enumerate(self.left):
            near = self.right[at + 1 :] if self.same_block else self.right
            n = self.n[near]
            near = near[(self.comp[near] != self.comp[k]) & (n * 100 >= self.n[k] * p.percent) & (self.n[k] * 100 >= n * p.percent)]
            if len(near):
                equal = self.sk[near] == self.sk[k]
                same = equal.sum(1)
                ok = same >= self.least
                near, same, equal = near[ok], same[ok], equal[ok]
            if len(near):
                first = equal.reshape(len(near), p.bands, p.rows).all(2).argmax(1) == self.band
                near, same = near[first], same[first]
            if len(near):
                yield k, near[np.argsort(-same, kind="stable")]


def with_candidates(dealt: DataFrame, nodes: DataFrame, p: NearDupParams) -> DataFrame:
    """The dealt rows that have a candidate in their group, with n and sk."""
    rows = dealt.join(nodes.select("v", "n", "sk"), "v").select("key", "i", "j", "blk", "v", "comp", "n", "sk")
    schema = T.StructType(rows.schema.fields)
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(slices):
        for group in grouped(slices, ("key", "i", "j")):
            needed = np.zeros(len(group), bool)
            for k, near in Candidates(group, p):
                needed[k] = True
                needed[near] = True
            yield [tuple(group[k].values()) for k in np.flatnonzero(needed)]

    return map_rows(rows, run, schema)


def verify_blocks(needed: DataFrame, texts: DataFrame, p: NearDupParams) -> DataFrame:
    """Links between components among the candidates of each group: enough to join all that are linked in it."""
    rows = texts.join(needed.hint("merge"), "v").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def run(slices):
        cache = WordHashes()
        for group in grouped(slices, ("key", "i", "j")):
            found = Candidates(group, p)
            sets: dict[int, np.ndarray] = {}
            parent = list(range(len(group)))

            def root(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            def of(k: int) -> np.ndarray:
                if k not in sets:
                    sets[k] = shingle_set(unsqueezed(group[k]["z"]), p.words, cache)
                return sets[k]

            out = []
            for k, near in found:
                at = 0
                while at < len(near):
                    mine = root(found.comp[k])
                    some = []
                    while at < len(near) and len(some) < 16:
                        if root(found.comp[near[at]]) != mine:
                            some.append(near[at])
                        at += 1
                    if some:
                        for q, linked in zip(some, reaches(of(k), [of(q) for q in some], p.percent), strict=True):
                            a, b = root(found.comp[k]), root(found.comp[q])
                            if linked and a != b:
                                parent[b] = a
                                out.append((group[k]["v"], group[q]["v"]))
            yield out

    return map_rows(rows, run, LINK)


def near_duplicates(docs: DataFrame, params: NearDupParams = NearDupParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id (least doc_id linked to it), kept, text_hash."""
    p = params
    docs = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    feats = cut(features(docs, p), "neardup-features")
    # one node for each distinct set, whatever the number of copies; v is the number of a row with its text
    nodes = cut(feats.where("n > 0").groupBy("cid").agg(F.min(F.when(F.col("sk").isNotNull(), F.col("at"))).alias("v"), F.min("id").alias("first"), F.count("*").alias("copies"), F.any_value("n").alias("n"), F.any_value("sk", F.lit(True)).alias("sk")), "neardup-nodes")
    texts = feats.where("sk is not null").select(F.col("at").alias("v"), "z")
    keyed = nodes.select("v", keys(p))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("v").alias("a")).where("members > 1").select("key", "a")
    star = keyed.join(shared, "key").where("v <> a").select("a", F.col("v").alias("b")).repartition("b")
    star = cut(star.groupBy("b", "a").agg(F.count("*").alias("hits")).groupBy("b").agg(F.max_by("a", "hits").alias("a")).select("a", "b"), "neardup-star")
    links = cut(verify_stars(star, texts, p), "neardup-links")
    labels = components(links)
    drop_cut(star)
    # what is left: keys that still hold several components
    placed = nodes.join(labels, "v", "left").select("v", F.coalesce("label", "v").alias("comp"), "sk").select("v", "comp", keys(p))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    rest = cut(placed.join(mixed, "key").select("key", "v", "comp"), "neardup-rest")
    if not rest.isEmpty():
        more = cut(verify_blocks(with_candidates(dealt_blocks(rest, p), nodes, p), texts, p), "neardup-links")
        labels = extended(labels, more)
        drop_cut(more)
    drop_cut(rest)
    drop_cut(links)
    classes = nodes.join(labels, "v", "left").where("label is not null or copies > 1").select("cid", "first", "label")
    least = cut(classes.where("label is not null").groupBy("label").agg(F.min("first").alias("least")), "neardup-least")
    of = cut(classes.join(least, "label", "left").select("cid", F.coalesce("least", "first").alias("component")), "neardup-classes")
    drop_cut(nodes)
    drop_cut(least)
    own = feats.select("id", "th", "n", "cid")
    out = own.where("cid is not null").join(of, "cid", "left").select("id", "th", "n", F.coalesce("component", "id").alias("component"))
    out = out.unionByName(own.where("cid is null").select("id", "th", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"), F.col("th").alias("text_hash"))


def dedup(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """documents with one row of each component; rows without words all stay. Columns unchanged."""
    judged = near_duplicates(docs, params).where("kept").select("doc_id", "text_hash", "n_shingles").distinct()
    # the row travels as one struct, so its own column names can't clash
    own = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    rows = own.join(judged, (F.col("id").eqNullSafe(F.col("doc_id"))) & (F.col("th") == F.col("text_hash")))
    first = rows.where("n_shingles > 0").withColumn("rn", F.row_number().over(W.partitionBy("id", "th").orderBy("th"))).where("rn = 1")
    return first.select("doc").unionByName(rows.where("n_shingles = 0").select("doc")).select(*[F.col("doc")[c].alias(c) for c in docs.columns])
