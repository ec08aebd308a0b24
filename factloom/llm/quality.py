"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (fixed-length slices of its whole text). Every passage is encoded from
counts of character classes and word repetition by a learned layer; gated attention (tanh times
sigmoid) weighs the passages; a linear layer scores the weighted representation. Only document
labels train it: encoder, attention and scorer together, by gradient descent on the log loss.

The fit uses at most max_train labelled rows, the first by a hash of the id (of a repeated id one row), of at most
max_bag passages each, encoded where they lie; the driver gets their passage features only. Scoring covers
every passage of every text. Defined cases: null or empty text: one passage of zeros, so a score like any other;
equal texts, equal scores; repeated ids in labels: 1 if one of them is; null labels are not used; no usable
label or a single class: every score is the share of ones (0.5 without labels); empty table: no rows; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import map_rows, pick

CLASSES = ("upper", "lower", "accent", "digit", "space", "line", ".", ",", "!?", "|", "#", "$%&*", "quote", "bracket", "-_=+/", "other")


@dataclass(frozen=True)
class QualityParams:
    """passage: characters; max_train, max_bag: the bounds on labelled rows that are fitted, and on the
    passages of each (longer labelled texts are scored, not fitted)."""

    passage: int = 512
    max_train: int = 8000
    max_bag: int = 512
    hidden: int = 16
    attention: int = 8
    steps: int = 400
    rate: float = 0.03
    decay: float = 1e-4
    threshold: float = 0.7


def _class_table() -> np.ndarray:
    marks = {".": 6, ",": 7, "!": 8, "?": 8, "|": 9, "#": 10, **dict.fromkeys("$%&*@~^", 11), **dict.fromkeys("\"'`", 12), **dict.fromkeys("()[]{}<>", 13), **dict.fromkeys("-_=+/\\:;", 14)}

    def kind(c: str) -> int:
        if c in marks:
            return marks[c]
        if c in "\n\r":
            return 5
        if c.isspace():
            return 4
        if c.isdigit():
            return 3
        if c.isupper():
            return 0
        if c.isalpha():
            return 1 if c < "\x80" else 2
        return 15

    return np.array([kind(chr(i)) for i in range(0x500)], np.int64)


TABLE = _class_table()
WIDTH = len(CLASSES) + 6


def passages(text: str | None, size: int) -> np.ndarray:
    """A row of features for each slice of the whole text; one row of zeros if there is none."""
    text = text or ""
    if not text:
        return np.zeros((1, WIDTH), np.float32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = TABLE[np.minimum(codes, 0x4FF)]
    n = -(-len(codes) // size)
    rows = np.arange(len(codes)) // size
    counts = np.bincount(rows * len(CLASSES) + kinds, minlength=n * len(CLASSES)).reshape(n, -1)
    out = np.zeros((n, WIDTH), np.float32)
    out[:, : len(CLASSES)] = np.sqrt(counts / counts.sum(1, keepdims=True))
    for i in range(n):
        words = text[i * size : (i + 1) * size].split()
        k = len(words)
        if not k:
            continue
        low = [w.lower() for w in words]
        out[i, len(CLASSES) :] = (
            len(set(low)) / k,
            sum(a == b for a, b in zip(low, low[1:], strict=False)) / k,
            min(sum(map(len, words)) / k / 10, 3.0),
            sum(not any(c.isalnum() for c in w[-1:]) for w in words) / k,
            sum(w.isupper() for w in words) / k,
            min(np.log1p(k) / 6, 1.5),
        )
    return out


class Model:
    """Parameters and forward pass; plain arrays, so that it travels in a closure."""

    def __init__(self, mean, scale, weights, prior=None):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def forward(self, x: np.ndarray, starts: np.ndarray):
        w1, b1, v, u, a, w2, b2 = self.weights
        h = np.tanh(((x - self.mean) / self.scale) @ w1 + b1)
        tv, su = np.tanh(h @ v), 1 / (1 + np.exp(-(h @ u)))
        e = (tv * su) @ a
        sizes = np.diff(np.r_[starts, len(x)])
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        att = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(att[:, None] * h, starts)
        score = 1 / (1 + np.exp(-np.clip(z @ w2 + b2, -30, 30)))
        return h, tv, su, att, z, score, sizes

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(bags), self.prior)
        starts = np.r_[0, np.cumsum([len(b) for b in bags])[:-1]]
        return self.forward(np.concatenate(bags).astype(np.float64), starts)[5]


def fit(bags: list[np.ndarray], labels: np.ndarray, p: QualityParams) -> Model:
    """Full-batch Adam on the log loss; the same bags and labels give the same model."""
    if not len(labels) or labels.min() == labels.max():
        return Model(None, None, None, float(labels.mean()) if len(labels) else 0.5)
    x = np.concatenate(bags).astype(np.float32)
    labels = labels.astype(np.float32)
    starts = np.r_[0, np.cumsum([len(b) for b in bags])[:-1]]
    rng = np.random.default_rng(7)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    d, h, k = x.shape[1], p.hidden, p.attention
    weights = [rng.normal(0, d**-0.5, (d, h)), np.zeros(h), rng.normal(0, h**-0.5, (h, k)), rng.normal(0, h**-0.5, (h, k)), rng.normal(0, k**-0.5, k), np.zeros(h), np.array(np.log(labels.mean() / (1 - labels.mean())))]
    mean, scale, weights = mean.astype(np.float32), scale.astype(np.float32), [w.astype(np.float32) for w in weights]
    model = Model(mean, scale, weights)
    xs = (x - mean) / scale
    m, s = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, p.steps + 1):
        hid, tv, su, att, z, score, sizes = model.forward(x, starts)
        w1, b1, v, u, a, w2, b2 = weights
        g = (score - labels) / len(labels)
        dz = np.repeat(g[:, None] * w2[None, :], sizes, 0)
        datt = (dz * hid).sum(1)
        de = att * (datt - np.repeat(np.add.reduceat(att * datt, starts), sizes))
        gate = tv * su
        dgate = de[:, None] * a[None, :]
        dpv, dpu = dgate * su * (1 - tv**2), dgate * tv * su * (1 - su)
        dh = att[:, None] * dz + dpv @ v.T + dpu @ u.T
        dpre = dh * (1 - hid**2)
        grads = [xs.T @ dpre, dpre.sum(0), hid.T @ dpv, hid.T @ dpu, gate.T @ de, z.T @ g, g.sum()]
        for i, (w, gr) in enumerate(zip(weights, grads, strict=True)):
            gr = gr + p.decay * w if i in (0, 2, 3, 4, 5) else gr
            m[i] = 0.9 * m[i] + 0.1 * gr
            s[i] = 0.999 * s[i] + 0.001 * gr**2
            weights[i] = (w - p.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(mean.astype(np.float64), scale.astype(np.float64), [w.astype(np.float64) for w in weights])


def train(docs: DataFrame, labels: DataFrame, p: QualityParams) -> Model:
    """docs: id, text. labels: id, label; those to learn from."""
    some = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").cast("double").alias("label"))
    # at most max_train narrow rows, so the join may broadcast them
    some = some.orderBy(F.xxhash64("id"), "id").limit(p.max_train)
    rows = docs.join(F.broadcast(some), "id")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.DoubleType()), T.StructField("x", T.BinaryType())])

    def run(slices):
        for rows_ in slices:
            yield [(r["id"], r["label"], passages(r["text"], p.passage).tobytes()) for r in rows_]

    bags = map_rows(rows.where(F.length("text").isNull() | (F.length("text") <= p.passage * p.max_bag)), run, schema)
    one = bags.groupBy("id").agg(F.min(F.struct("x", "label")).alias("one")).select("id", "one.*")
    got = sorted(((r["id"], bytes(r["x"]), r["label"]) for r in one.collect()))
    return fit([np.frombuffer(x, np.float32).reshape(-1, WIDTH) for _, x, _ in got], np.array([y for _, _, y in got]), p)


def score_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted. Held-out ids never train the model."""
    p = params
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    held = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) == 2
    known = pick(labels, id=id_col, label=label_col).withColumn("id", F.col("id").cast("long")).where(~held)
    model = train(rows, known, p)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(slices):
        for rows_ in slices:
            yield list(zip([r["id"] for r in rows_], model.scores([passages(r["text"], p.passage) for r in rows_]).tolist(), strict=True))

    out = map_rows(rows, run, schema)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """documents without the rows whose text scores below the threshold; columns unchanged."""
    p = params
    rows = pick(docs, id="doc_id", text="text").withColumn("id", F.col("id").cast("long"))
    held = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(4)) == 2
    model = train(rows, pick(labels, id="doc_id", label="quality").withColumn("id", F.col("id").cast("long")).where(~held), p)
    schema, names = T.StructType(docs.schema.fields), docs.columns

    def run(slices):
        for rows_ in slices:
            good = model.scores([passages(r["text"], p.passage) for r in rows_]) >= p.threshold
            yield [tuple(r[c] for c in names) for r, ok in zip(rows_, good, strict=True) if ok]

    return map_rows(docs, run, schema)
