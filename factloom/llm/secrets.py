"""Secret scan with corpus-wide ownership frequency.

Base kinds (assign, access, hex) are found by fixed patterns in whole texts. The method then takes
every candidate value (the values of base matches and further long tokens), hashes it and counts in
how many distinct repositories and with how many distinct owners it occurs in the whole corpus, and which share of
its repositories its greatest owner has. A value that many owners publish, none of whom has most of it, is a
copied example; a value that few owners hold, or that one owner has most of, is a live-looking credential.
Live values that look random add spans wherever they occur and base spans do not cover
them (kind "live"); base spans always stay, with their class and counts beside them.

Counting is over distinct (hash, repository, owner), combined before the shuffle, so one value that
a third of all rows repeat is a few rows per task. Spans meet their value's counts in a join of two written tables,
where Spark may split a value that very many rows have. Defined cases: null or empty text: no spans; null owner
or repository counts as one owner or repository of its own; repeated rows count once, and each has its spans; empty
table: no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import cut, map_rows, pick

# The base patterns and their least lengths, as the contract states them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "live")
#: Further candidates: long tokens of a credential's alphabet.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("vstart", T.LongType()), T.StructField("hash", T.LongType())]))


@dataclass(frozen=True)
class SecretParams:
    """A value is an example if it has more than max_owners owners or max_repositories repositories and no owner has
    at least the share `main` of its repositories. bits: least entropy a character of added values."""

    max_owners: int = 3
    max_repositories: int = 6
    main: float = 0.5
    bits: float = 3.0


def signed(value: str) -> int:
    h = xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def base_spans(text: str) -> list[tuple[str, int, int, int, str]]:
    """(kind, start, end, start of the value, value) of the base kinds, in code points."""
    out = [("assign", m.start(), m.end(), m.start(2), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end(), m.start(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m.start(), m[0]) for m in re.finditer("[0-9a-f]{24,}", text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def looks_random(value: str, bits: float) -> bool:
    """Letters and digits mixed, and not a few characters repeated."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= bits


def merged(spans: list[tuple]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of the spans, which are sorted by start."""
    starts, ends = [], []
    for _, a, b, *_ in spans:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def spans_of(text: str | None, bits: float) -> tuple[list[tuple], list[tuple]]:
    """Base spans and further candidates, each (kind, start, end, vstart, hash).

    A candidate that overlaps base spans counts unless they cover it: it holds characters that no base span has.
    """
    text = text or ""
    base, extra = base_spans(text), []
    starts, ends = merged(base)
    names = [s[1] for s in base if s[0] == "assign"]
    for m in TOKEN.finditer(text):
        # an assignment inside goes on to the token's end; what stands before it is judged alone
        start, end = m.span()
        k = bisect_right(names, start)
        if k < len(names) and names[k] < end:
            end = names[k]
        value = text[start:end]
        k = bisect_right(starts, start) - 1
        covered = k >= 0 and ends[k] >= end
        if not covered and len(value) >= 20 and looks_random(value, bits):
            extra.append(("live", start, end, start, signed(value)))
    return [(*s[:4], signed(s[4])) for s in base], extra


def candidates(docs: DataFrame, p: SecretParams) -> DataFrame:
    """Per row: id, owner, repository, base, extra (arrays of spans), texts left behind."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("owner", T.StringType()), T.StructField("repository", T.StringType()), T.StructField("base", SPAN), T.StructField("extra", SPAN)])
    names = [f.name for f in SPAN.elementType]

    def run(slices):
        for rows in slices:
            out = []
            for r in rows:
                base, extra = spans_of(r["text"], p.bits)
                out.append((r["id"], r["owner"], r["repository"], [dict(zip(names, s, strict=True)) for s in base], [dict(zip(names, s, strict=True)) for s in extra]))
            yield out

    return map_rows(docs, run, schema)


def ownership(found: DataFrame, p: SecretParams) -> DataFrame:
    """Per candidate hash: owners, repositories (distinct, over the whole corpus) and class, as a written table."""
    every = found.select("owner", "repository", F.explode(F.array_union(F.col("base.hash"), F.col("extra.hash"))).alias("hash"))
    pairs = every.select("hash", F.coalesce("owner", F.lit("\0")).alias("owner"), F.coalesce("repository", F.lit("\0")).alias("repository")).distinct()
    per_owner = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    freq = per_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories"), F.max("n").alias("most"))
    copied = ((F.col("owners") > p.max_owners) | (F.col("repositories") > p.max_repositories)) & (F.col("most") < p.main * F.col("repositories"))
    return cut(freq.select("hash", "owners", "repositories", F.when(copied, "example").otherwise("live").alias("class")), "secret-ownership")


def scan_secrets(docs: DataFrame, params: SecretParams = SecretParams(), id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """Per input row: doc_id and spans, an array of (kind, start, end, vstart, class, owners, repositories) by place.

    class is "example" (widely copied) or, by its ownership, "live".
    """
    p = params
    have = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in repository_cols]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{owner_col}`").cast("string").alias("owner"), F.concat_ws("\1", *have).alias("repository"))
    found = cut(candidates(rows, p).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    freq = ownership(found, p)
    flat = found.select("row", F.explode(F.concat("base", "extra")).alias("s")).select("row", "s.*")
    judged = flat.join(freq, "hash").where("kind <> 'live' or class = 'live'")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    names = ["kind", "start", "end", "vstart", "class", "owners", "repositories"]
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "end", "vstart", "kind", "class", "owners", "repositories"))).alias("spans"))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,vstart:bigint,class:string,owners:bigint,repositories:bigint>>")
    shown = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in names]))
    return found.select("row", F.col("id").alias("doc_id")).join(spans, "row", "left").select("doc_id", F.coalesce(shown, empty).alias("spans"))


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from scan_secrets' spans, and by span its class, owners and repositories."""
    joined = lambda spans, *fields: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *[s[c].cast("string") for c in fields])), ",")
    text = lambda spans: joined(spans, "kind", "start", "end")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "live")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"), joined(F.col("spans"), "class", "owners", "repositories").alias("ownership"))


def redact(docs: DataFrame, params: SecretParams = SecretParams(), mark: str = "[secret]") -> DataFrame:
    """documents with every live value, base or added, replaced by a mark; all rows and columns stay.

    The rows carry their text through one join on a digest of the scanned text, so repeated ids are safe.
    """
    p = params
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    repository = F.concat_ws("\1", F.coalesce("source", F.lit("\0")), F.coalesce("lang", F.lit("\0")))
    found = cut(candidates(docs.select(th.alias("id"), "text", F.col("source").alias("owner"), repository.alias("repository")), p).where("size(base) + size(extra) > 0"), "secret-candidates")
    live = ownership(found, p).where("class = 'live'").select("hash")
    by_text = found.select("id", F.explode(F.array_union(F.col("base.hash"), F.col("extra.hash"))).alias("hash")).distinct()
    # written, so that Spark may split a text that very many rows have
    by_text = cut(by_text.join(live, "hash", "left_semi").groupBy("id").agg(F.collect_set("hash").alias("live")), "secret-live")
    # the row travels as one struct, so its own column names can't clash
    joined = docs.select(F.struct(*docs.columns).alias("doc"), th.alias("id")).join(by_text, "id", "left")
    schema, names = T.StructType(docs.schema.fields), docs.columns

    def run(slices):
        for rows in slices:
            out = []
            for r in rows:
                doc = r["doc"]
                if r["live"]:
                    doc["text"] = redacted(doc["text"], set(r["live"]), p.bits, mark)
                    if "n_chars" in doc:
                        doc["n_chars"] = len(doc["text"])
                out.append(tuple(doc[c] for c in names))
            yield out

    return map_rows(joined.select("doc", "live"), run, schema)


def redacted(text: str, live: set[int], bits: float, mark: str) -> str:
    """The text with a mark for each run of live values that overlap: their union goes."""
    base, extra = spans_of(text, bits)
    out, at = [], 0
    for start, end in sorted((s[3], s[2]) for s in base + extra if s[4] in live):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]
