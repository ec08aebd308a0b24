"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Documents are tokenized once where they lie; only their pieces' lengths matter for the plan, and a
length is at most the capacity, so the whole instance is a histogram of at most `capacity` counts,
however many documents there are. The reduction fixes small sets that provably some optimal packing
contains: an item that nothing fits beside; an item with its largest fitting partner where that
partner dominates every other feasible filling (it fills the bin exactly, or no two smaller items fit, or it
is at least as large as the sum of any two that do). What remains is packed best fit, decreasing.
Both work on runs of equal bins, so their time depends on the number of distinct lengths.

Pieces get their places without a global sort: a piece's rank among its length is its partition's
offset plus its rank in the partition, and the plan maps ranks to sequences and offsets.

Defined cases: null or empty text: only the end token. Repeated rows and ids: each row is packed.
Long texts: whole, cut into full pieces after a possibly shorter first one. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_left, bisect_right

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from factloom.llm.common import cut, kept_by_process, map_rows, pick

#: The split pattern of the public byte-level vocabulary, a fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space inside or at the end of a run of white space: only there do neighbours matter to a word.
RUN = re.compile(r"\s (?:\s|$)")


def encoder(path: str):
    """The vocabulary file's byte-level BPE, with ids as merge ranks."""
    return kept_by_process(("encoder", path), lambda: build_encoder(path))


def build_encoder(path: str):
    import tiktoken

    vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocab.items() if all(c in byte_of for c in word) and word != "<|endoftext|>"}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def whole(path: str):
    """The tokenizers file itself, for texts that contain one of its added tokens."""
    from tokenizers import Tokenizer

    return kept_by_process(("tokenizer", path), lambda: Tokenizer.from_file(path))


def added_tokens(path: str) -> tuple[str, ...]:
    return tuple(t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"])


class WordIds(dict):
    """Little-endian 32-bit ids of words with a leading space; starts anew when it has grown."""

    def __init__(self, path: str):
        self.path = path
        self.added = kept_by_process(("added", path), lambda: added_tokens(path))
        self.encode = encoder(path).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = np.array(self.encode(" " + word), "<u4").tobytes()
        return value

    def ids(self, text: str) -> bytes:
        """The ids of the whole text. A single space between words is always a boundary."""
        if any(t in text for t in self.added):
            return np.array(whole(self.path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if RUN.search(text):
            return np.array(self.encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encode(first), "<u4").tobytes() + b"".join(map(self.__getitem__, rest))


def tokenized(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Per piece: id, piece, start, length, crc, part (its task) and local (rank of its length there)."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("crc", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(slices):
        words, seen, part = WordIds(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for rows in slices:
            out = []
            for r in rows:
                ids = words.ids(r["text"] or "") + end
                n = len(ids) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = (n - 1) % capacity + 1 if not piece else start + capacity
                    out.append((r["id"], piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), part, int(seen[stop - start])))
                    seen[stop - start] += 1
                    start = stop
            yield out

    return map_rows(docs, run, schema)


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Fix dominating sets: (bins as (lengths, how many), what remains), largest item first."""
    sizes, left, fixed = sorted(counts), dict(counts), []
    for size in reversed(sizes):
        while left.get(size):
            room = capacity - size
            rest = [s for s in sizes if left.get(s, 0) - (s == size) > 0]
            if not rest or rest[0] > room:
                fixed.append(((size,), 1 if rest and rest[0] == size else left[size]))
                left[size] -= fixed[-1][1]
                continue
            best = rest[bisect_right(rest, room) - 1]
            smallest = rest[0]
            second = smallest if left[smallest] - (smallest == size) > 1 else (rest[1] if len(rest) > 1 else capacity)
            if best != room and smallest + second <= room and not dominates(best, rest, left, size, room):
                break
            n = left[size] // 2 if best == size else min(left[size], left[best])
            # without an exact fit the largest partner or the smallest items may run out: one at a time
            n = n if best == room or smallest + second > room else 1
            fixed.append(((size, best), n))
            left[size] -= n
            left[best] -= n
    return fixed, {s: n for s, n in left.items() if n}


def dominates(best: int, rest: list[int], left: dict[int, int], size: int, room: int) -> bool:
    """Whether every pair (or more) that fits in room sums to at most best, so best may stand for it."""
    have = lambda s: left[s] - (s == size)
    three = sorted(s for s in rest[:3] for _ in range(min(3, have(s))))[:3]
    if len(three) == 3 and sum(three) <= room:
        return False
    top = 0
    for i, a in enumerate(rest):
        if 2 * a > room:
            break
        j = bisect_right(rest, room - a) - 1
        if j > i or j == i and have(a) > 1:
            top = max(top, a + rest[j])
        elif j == i and i:
            top = max(top, a + rest[i - 1])
    return top <= best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing over runs of equal open bins."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, bin_: tuple[int, ...], n: int) -> None:
        if n:
            if room not in open_:
                rooms.insert(bisect_left(rooms, room), room)
                open_[room] = []
            open_[room].append((bin_, n))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                bin_, bins = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                bin_, bins = (), n
            # a bin that just took an item is the tightest still: it takes as many as fit
            each = room // size
            full = min(bins, n // each)
            put(room - each * size, (*bin_, *[size] * each), full)
            n -= full * each
            used = full
            if n and full < bins:
                put(room - min(n, each) * size, (*bin_, *[size] * min(n, each)), 1)
                n -= min(n, each)
                used += 1
            if at < len(rooms) or bin_:
                put(room, bin_, bins - used)
    return [b for found in open_.values() for b in found]


def plan(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Per length: runs (first rank, first sequence, items a sequence, offset, count) by first rank."""
    fixed, rest = reduce_dominated(counts, capacity)
    runs: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for lengths, n in fixed + best_fit(rest, capacity):
        at, k = 0, 0
        while k < len(lengths):
            size, m = lengths[k], 0
            while k + m < len(lengths) and lengths[k + m] == size:
                m += 1
            runs.setdefault(size, []).append((taken.get(size, 0), sequence, m, at, n * m))
            taken[size] = taken.get(size, 0) + n * m
            at += m * size
            k += m
        sequence += n
    return runs


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    pieces = cut(tokenized(rows, tokenizer_path, end_id, capacity), "packing-pieces")
    local = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # at most `capacity` rows reach the driver
    counts = {r["length"]: r["n"] for r in local.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = local.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).select("id", "piece", "start", "length", "crc", (F.col("before") + F.col("local")).alias("rank"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    firsts = {size: [r[0] for r in found] for size, found in runs.items()}

    def run(slices):
        for rows_ in slices:
            out = []
            for r in rows_:
                size = r["length"]
                first, sequence, m, at, _ = runs[size][bisect_right(firsts[size], r["rank"]) - 1]
                q, k = divmod(r["rank"] - first, m)
                out.append((r["id"], r["piece"], r["start"], size, r["crc"], sequence + q, at + k * size))
            yield out

    return map_rows(ranked, run, schema)
