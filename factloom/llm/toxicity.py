"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear (logistic) models over the presence of
terms; the probability of every earlier category is a feature of the later ones. While training,
earlier probabilities are out of fold, so later models learn from predictions as unsure as those
they will get. Terms are chosen by how far their presence departs from independence of the last label.

The labels' table marks toxicity as a whole, the chain's last category. Earlier ones are weak labels:
a toxic document that has one of the category's terms. Those are found in the labelled rows, whatever
their language: the chosen terms that toxic rows have more often, strongest first, each given to the
category that covers fewer toxic rows so far. No word is fixed here. With other label columns, pass
them in the order of the chain.

The fit uses at most max_train labelled rows (the first by a hash of the id, equal texts once, toxic if one of
them is); every term of theirs that is strong enough is a feature, and the driver gets which of these each row has.
Scoring covers whole texts. Defined cases: null or empty text: no terms, so the score of the intercepts; equal
texts, equal scores, whatever their labels; repeated ids: toxic if one of their labels is; null
labels are not used; no labels or one class: a category predicts its share; empty table: no rows; extra columns
are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import cut, drop_cut, map_rows, pick

WORD = re.compile(r"[^\W\d_]+")

#: The weak categories that come before the labelled one.
WEAK = ("weak_1", "weak_2")


@dataclass(frozen=True)
class ToxicityParams:
    """max_train: the bound on labelled rows that are fitted; strength: least standard deviations between a
    term's toxic rows and their expected number, for a feature."""

    max_train: int = 16_000
    strength: float = 4.0
    least_rows: int = 4
    folds: int = 4
    steps: int = 250
    rate: float = 0.2
    decay: float = 1e-4
    threshold: float = 0.5


def terms(text: str | None) -> set[str]:
    return {w.casefold() for w in WORD.findall(text or "")}


class Rows:
    """Which terms each row has, as (row, column) pairs, and dense columns beside them."""

    def __init__(self, columns: list[np.ndarray], width: int, dense: np.ndarray | None = None):
        self.n, self.width = len(columns), width
        self.row = np.repeat(np.arange(self.n), [len(c) for c in columns]) if columns else np.empty(0, np.int64)
        self.column = np.concatenate(columns) if columns else np.empty(0, np.int64)
        self.dense = np.zeros((self.n, 0)) if dense is None else dense

    def times(self, w: np.ndarray) -> np.ndarray:
        """Scores by weights of terms, dense columns and the intercept."""
        return np.bincount(self.row, w[self.column], self.n) + self.dense @ w[self.width : -1] + w[-1]

    def gradient(self, g: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(self.column, g[self.row], self.width), self.dense.T @ g, g.sum()]

    def some(self, mine: np.ndarray) -> Rows:
        out = Rows([], self.width, self.dense[mine])
        held = mine[self.row]
        out.n, out.row, out.column = int(mine.sum()), (np.cumsum(mine) - 1)[self.row[held]], self.column[held]
        return out

    def beside(self, more: np.ndarray) -> Rows:
        out = self.some(np.ones(self.n, bool))
        out.dense = np.c_[self.dense, more]
        return out


def logistic(x: Rows, y: np.ndarray, p: ToxicityParams) -> np.ndarray:
    """Weights with the intercept last; Adam on the log loss with a ridge term, classes weighed evenly."""
    w = np.zeros(x.width + x.dense.shape[1] + 1)
    share = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    if not len(y) or y.min() == y.max():
        w[-1] = np.log(share / (1 - share))
        return w
    weigh = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)) / len(y)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, p.steps + 1):
        grad = x.gradient(weigh * (probability(x, w) - y))
        grad[:-1] += p.decay * w[:-1]
        m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
        w = w - p.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return w


def probability(x: Rows, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.times(w), -30, 30)))


@dataclass
class Chain:
    """vocabulary: term to column; models: a weight vector for each category, in order."""

    vocabulary: dict[str, int]
    models: list[np.ndarray]

    def predict(self, texts: list[str | None]) -> np.ndarray:
        known = self.vocabulary.keys()
        x = Rows([np.array([self.vocabulary[t] for t in terms(text) & known], np.int64) for text in texts], len(known))
        for w in self.models:
            x = x.beside(probability(x, w))
        return x.dense


def fit_chain(x: Rows, labels: np.ndarray, folds: np.ndarray, p: ToxicityParams) -> list[np.ndarray]:
    """labels: a column for each category; folds: a fold number for each row."""
    models = []
    for y in labels.T:
        models.append(logistic(x, y, p))
        out_of_fold = np.zeros(len(y))
        for k in range(p.folds):
            mine = folds == k
            if mine.any():
                out_of_fold[mine] = probability(x.some(mine), logistic(x.some(~mine), y[~mine], p))
        x = x.beside(out_of_fold)
    return models


def weak_labels(x: Rows, label: np.ndarray, leading: list[int]) -> np.ndarray:
    """A column for each weak category. leading: columns of x that toxic rows have more often, strongest first."""
    y = np.zeros((len(label), len(WEAK)))
    order = np.argsort(x.column, kind="stable")
    rows, ends = x.row[order], np.searchsorted(x.column[order], np.arange(x.width + 1))
    for column in leading:
        having = rows[ends[column] : ends[column + 1]]
        y[having[label[having] > 0], int(np.argmin(y.sum(axis=0)))] = 1
    return y


def train(docs: DataFrame, labels: DataFrame, p: ToxicityParams) -> Chain:
    """docs: id, text. labels: id, label."""
    some = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").cast("int").alias("label"))
    # at most max_train narrow rows, so the join may broadcast them
    some = some.orderBy(F.xxhash64("id"), "id").limit(p.max_train)
    rows = docs.join(F.broadcast(some), "id").withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("terms", T.ArrayType(T.StringType()))])

    def run(slices):
        for rows_ in slices:
            yield [(r["key"], r["label"], sorted(terms(r["text"]))) for r in rows_]

    each = map_rows(rows, run, schema).groupBy("key").agg(F.max("label").alias("label"), F.any_value("terms").alias("terms"))
    sample = cut(each, "toxicity-sample")
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    by_term = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("k")).where(F.col("n") >= p.least_rows)
    share = ones / max(n, 1)
    expected = F.col("n") * F.lit(share)
    strength = F.abs(F.col("k") - expected) / F.sqrt(expected * F.lit(1 - share) + F.lit(0.25))
    found = by_term.where(strength >= p.strength).select("term", (F.col("k") > expected).alias("more"), strength.alias("strength")).collect()
    found.sort(key=lambda r: (-r["strength"], r["term"]))
    vocabulary = {r["term"]: i for i, r in enumerate(found)}
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("columns", T.ArrayType(T.IntegerType()))])

    def known(slices):
        for rows_ in slices:
            yield [(r["key"], r["label"], sorted(vocabulary[t] for t in r["terms"] if t in vocabulary)) for r in rows_]

    kept = sorted(map_rows(sample, known, schema).collect(), key=lambda r: r["key"])
    drop_cut(sample)
    x = Rows([np.array(r["columns"], np.int64) for r in kept], len(vocabulary))
    label = np.array([r["label"] for r in kept], float)
    y = np.c_[weak_labels(x, label, [i for i, r in enumerate(found) if r["more"]]), label]
    folds = np.array([r["key"] % p.folds for r in kept], np.int64)
    return Chain(vocabulary, fit_chain(x, y, folds, p))


def score_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per input row: doc_id, score and predicted (the last category), and the earlier probabilities."""
    p = params
    rows = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    chain = train(rows, pick(labels, id=id_col, label=label_col).withColumn("id", F.col("id").cast("long")), p)
    names = [*WEAK, "score"]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in names]])

    def run(slices):
        for rows_ in slices:
            yield [(r["id"], *found) for r, found in zip(rows_, chain.predict([r["text"] for r in rows_]).tolist(), strict=True)]

    out = map_rows(rows, run, schema)
    return out.select("doc_id", "score", (F.col("score") >= p.threshold).cast("int").alias("predicted"), *WEAK)
