"""Operator 6, toxicity: cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - x . w): one weight vector for all ordered thresholds. x has, for each chosen
feature of a text, log(1 + its count); features are hashed words and beginnings of words. The expected severity is the
sum of P(grade >= k), k = 1 .. K.

Labels only say toxic or not. Grade 0 is "not toxic"; toxic rows of the sample get grades 1 to K in equal parts, by
the evidence that their features give (summed log odds against the rows that aren't toxic).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.words import words

#: Fit: rows of each label at most, in the order of a hash; features, the surest (more bring in words of often copied texts, which add
#: up in very long ones); a feature's least toxic rows; grades beyond 0.
SAMPLE, FEATURES, SUPPORT, GRADES = 2000, 128, 5, 3
PREFIXES, SPACE_BITS = (4, 5, 6), 30
RIDGE, STEPS = 1e-5, 500
SCHEMA = "doc_id long, severity double, p_toxic double, grade int, toxic boolean"


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row, feature) in slices: each word, and its beginnings where it is longer."""
    shift = np.uint64(64 - SPACE_BITS)
    for w in words(column, PREFIXES):
        row = np.repeat(np.arange(w.rows), np.diff(w.offsets))
        parts = [(row, w.hash >> shift)] + [(row[p != 0], p[p != 0] >> shift) for p in w.prefix.values()]
        yield w.first, w.rows, np.concatenate([r for r, _ in parts]), np.concatenate([f for _, f in parts]).astype(np.int64)


@dataclass
class Model:
    features: np.ndarray  # sorted
    weights: np.ndarray
    thresholds: np.ndarray  # rising

    def score(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k) of each text, by k."""
        x = np.zeros(len(column))
        for first, rows, row, feature in _features(column) if len(self.features) else ():
            at = np.minimum(np.searchsorted(self.features, feature), len(self.features) - 1)
            hit = self.features[at] == feature
            cell, n = np.unique(row[hit] * len(self.features) + at[hit], return_counts=True)
            x[first : first + rows] = np.bincount(cell // len(self.features), np.log1p(n) * self.weights[cell % len(self.features)], minlength=rows)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - x[:, None], -500, 500)))


NOTHING = Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES, 500.0))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, features, counts) of each text."""
    for b in batches:
        lists: list[tuple[np.ndarray, np.ndarray]] = []
        for _, rows, row, feature in _features(b.column(1)):
            cell, n = np.unique((row.astype(np.int64) << SPACE_BITS) | feature, return_counts=True)
            at = np.searchsorted(cell >> SPACE_BITS, np.arange(rows + 1))
            lists += [((cell[i:j] & ((1 << SPACE_BITS) - 1)).astype(np.int32), n[i:j].astype(np.int32)) for i, j in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in lists], pa.list_(pa.int32())), pa.array([n for _, n in lists], pa.list_(pa.int32()))], ["toxic", "features", "counts"])


def ordinal_fit(x: np.ndarray, y: np.ndarray, grades: int, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of a cumulative-link model by gradient steps with momentum and own rates (Adam).
    Thresholds are a first one and the logarithms of the gaps, so they stay in order."""
    n, m = x.shape
    free = np.concatenate([np.zeros(m), [2.0], np.zeros(grades - 1)])
    first, second = np.zeros_like(free), np.zeros_like(free)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, STEPS + 1):
        w, gaps = free[:m], np.exp(free[m + 1 :])
        theta = free[m] + np.concatenate([[0], np.cumsum(gaps)])
        z = x @ w
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        up, low = edge[y + 1] - z, edge[y] - z
        cu, cl = np.where(np.isinf(up), 1.0, sigmoid(np.where(np.isinf(up), 0, up))), np.where(np.isinf(low), 0.0, sigmoid(np.where(np.isinf(low), 0, low)))
        p = np.maximum(cu - cl, 1e-12)
        du, dl = cu * (1 - cu) / p * weight, cl * (1 - cl) / p * weight
        by_theta = np.array([dl[y == k + 1].sum() - du[y == k].sum() for k in range(grades)])  # of the loss
        grad_gaps = np.array([by_theta[k + 1 :].sum() for k in range(grades - 1)]) * gaps
        grad = np.concatenate([x.T @ (du - dl) + RIDGE * w * weight.sum(), [by_theta.sum()], grad_gaps]) / weight.sum()
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        free = free - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return free[:m], free[m] + np.concatenate([[0], np.cumsum(np.exp(free[m + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From at most ``sample`` rows of each label (labels: doc_id, toxic; of several the largest counts, nulls don't).
    Without rows of both labels nothing is learned, and no text is toxic."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    known = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    one = F.broadcast(picked[0].union(picked[1]))  # 2 * sample rows at most
    rows = texts.join(one, "doc_id").select("toxic", "text").mapInArrow(_sampled, "toxic int, features array<int>, counts array<int>").toArrow().to_pandas()
    toxic = rows["toxic"].to_numpy() == 1
    if not toxic.any() or toxic.all():
        return NOTHING
    sizes = rows["features"].map(len).to_numpy()
    feature, count, row = np.concatenate(rows["features"].to_list()), np.concatenate(rows["counts"].to_list()), np.repeat(np.arange(len(rows)), sizes)
    kinds, at = np.unique(feature, return_inverse=True)
    with_it = np.bincount(at, toxic[row], len(kinds))
    without = np.bincount(at, ~toxic[row], len(kinds))
    pos, neg = (with_it + 0.5) / (toxic.sum() + 1), (without + 0.5) / ((~toxic).sum() + 1)
    odds = np.log(pos / (1 - pos)) - np.log(neg / (1 - neg))
    # how sure the difference is: the gap of the two rates against its standard error
    sure = np.abs(pos - neg) / np.sqrt(pos * (1 - pos) / toxic.sum() + neg * (1 - neg) / (~toxic).sum())
    sure[with_it < min(SUPPORT, max(1, toxic.sum() // 4))] = 0
    best = np.sort(np.argsort(-sure, kind="stable")[:FEATURES])
    best = best[sure[best] > 4] if (sure[best] > 4).any() else best[sure[best] > 0]
    if not len(best):
        return NOTHING
    place = np.full(len(kinds), -1)
    place[best] = np.arange(len(best))
    x = np.zeros((len(rows), len(best)), np.float64)
    use = place[at] >= 0
    x[row[use], place[at[use]]] = np.log1p(count[use])
    evidence = x @ odds[best]
    rank = np.empty(toxic.sum(), int)
    rank[np.argsort(evidence[toxic], kind="stable")] = np.arange(toxic.sum())
    y = np.zeros(len(rows), int)
    y[toxic] = 1 + rank * GRADES // toxic.sum()
    weights, thresholds = ordinal_fit(x, y, GRADES, np.ones(len(rows)))
    return Model(kinds[best].astype(np.int64), weights, thresholds)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, severity (expected grade), p_toxic (P(grade >= 1)), grade (the median one) and toxic (p_toxic >= 0.5) of
    each row of ``docs`` (doc_id, text; other columns are ignored), whole texts; a null text has no features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = shared.value.score(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0] >= 0.5)], ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with their columns."""
    shared, at, schema = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(shared.value.score(b.column(at))[:, 0] < 0.5))

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return grade(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE_SQL: dict[str, str] = {}
