"""Operator 7, approximate nearest neighbours: multi-index hashing.

Vectors are lengthened by one component that gives all the same norm, which makes the largest inner product the smallest
angle. Their codes are signs after learned rotations (principal components, then iterative quantisation). A code is cut
into substrings of one byte, and each substring has a table from its values to codes. Codes within Hamming radius r of a
query agree with it up to r / substrings bits in at least one substring (pigeonhole), so probing the values that near in
every table finds them all. They are reranked by inner products of the original vectors in double precision.

The radius is learned, too: so large that it holds the WITHIN quantile of the sample's own nearest vectors. Every row is
in the index. Index and queries are dealt into blocks; each pair of blocks is a group that returns its best K of each
query. A group where the radius holds fewer than K raises it there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.llm.shared import tasks, written

#: Fit: vectors, in the order of a hash; bits of a code; the part of true neighbours that the radius is to hold.
SAMPLE, BITS, ROUNDS, WITHIN = 8000, 128, 25, 0.98
K, INDEX_BLOCK, QUERY_BLOCK, AT_ONCE = 20, 8192, 8192, 256
RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass
class Codes:
    centre: np.ndarray
    turn: np.ndarray  # (dimensions + 1, BITS)
    norm: float
    radius: int
    scale: float = 1.0  # the largest component of all: squares of what is divided by it are finite

    def of(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as rows of bytes. A query is lengthened by 0, which keeps its order of inner products."""
        x = x / (np.abs(x).max(axis=1, keepdims=True) if query else self.scale)  # a query's length doesn't matter
        size = np.sqrt((x * x).sum(axis=1))
        if query:
            long = np.column_stack([x / size[:, None] * self.norm, np.zeros(len(x))])
        else:
            long = np.column_stack([x, np.sqrt(np.maximum(0, self.norm**2 - size**2))])
        return np.packbits((long - self.centre) @ self.turn > 0, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of each row of a to each of b."""
    wide = lambda x: np.ascontiguousarray(x).view(np.uint64)
    return np.bitwise_count(wide(a)[:, None, :] ^ wide(b)[None, :, :]).sum(axis=2, dtype=np.int16)


def fit(x: np.ndarray, norm: float, scale: float = 1.0, seed: int = 7) -> Codes:
    """From a sample of vectors, the largest component of all, and the largest norm of all after division by it."""
    whole, x = x, x / scale
    rng = np.random.default_rng(seed)
    long = np.column_stack([x, np.sqrt(np.maximum(0, norm**2 - (x * x).sum(axis=1)))])
    centre = long.mean(axis=0)
    long = long - centre
    _, axes = np.linalg.eigh(long.T @ long)
    turns, left = [], BITS
    while left:
        n = min(left, x.shape[1])
        low = long @ (axes := axes[:, ::-1])[:, :n] if not turns else long @ axes[:, :n]
        turn = np.linalg.qr(rng.standard_normal((n, n)))[0]
        for _ in range(ROUNDS):
            u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ v).T
        turns.append(axes[:, :n] @ turn)
        left -= n
    codes = Codes(centre, np.column_stack(turns), norm, BITS, scale)
    ask = x[:: max(1, len(x) // 500)][:500]
    ask = ask[(ask != 0).any(axis=1)]  # beside far larger ones, a vector may vanish
    products = ask @ x.T
    own = products >= np.sort(products, axis=1)[:, -min(K + 1, len(x))][:, None]
    codes.radius = int(np.quantile(distances(codes.of(ask, True), codes.of(whole))[own], WITHIN))
    return codes


class MultiIndex:
    """Substring tables over codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.start = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """(queries, codes): which codes are within the Hamming radius."""
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= radius // queries.shape[1]
        hit = np.zeros((len(queries), len(self.codes)), bool)
        for j, (order, start) in enumerate(zip(self.order, self.start, strict=True)):
            for value in np.flatnonzero(np.diff(start)):
                asks = np.flatnonzero(near[queries[:, j], value])
                hit[asks[:, None], order[start[value] : start[value + 1]]] = True
        q, c = np.nonzero(hit)
        wide = lambda x: np.ascontiguousarray(x).view(np.uint64)
        ok = np.bitwise_count(wide(queries)[q] ^ wide(self.codes)[c]).sum(axis=1) <= radius
        hit[q[~ok], c[~ok]] = False
        return hit


def _best(ids: np.ndarray, x: np.ndarray, ask_ids: np.ndarray, ask: np.ndarray, codes: Codes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, identifiers, scores) of the best K of each query in a block."""
    index = MultiIndex(codes.of(x))
    for a in range(0, len(ask), AT_ONCE):
        own = ask[a : a + AT_ONCE]
        signs = codes.of(own, True)
        hit = index.within(signs, codes.radius)
        need = min(K + 1, len(ids))
        few, radius = np.flatnonzero(hit.sum(axis=1) < need), codes.radius
        while len(few):
            radius = min(BITS, radius + max(4, radius // 8))
            hit[few] = index.within(signs[few], radius)
            few = few[hit[few].sum(axis=1) < need] if radius < BITS else few[:0]
        for q in range(len(own)):
            at = np.flatnonzero(hit[q])
            at = at[ids[at] != ask_ids[a + q]]
            score = (x[at] * own[q]).sum(axis=1)  # row by row alike, so equal vectors get equal scores
            best = np.lexsort((ids[at], -score))[:K]
            yield int(ask_ids[a + q]), ids[at[best]], score[best]


def nearest(vectors: DataFrame, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the K nearest of each row whose vec_id is divisible by ``every``, of ``vectors``
    (vec_id, embedding; other columns are ignored).

    Null and zero vectors and those with a null or non-finite component take no part, nor do rows without a vec_id and
    vectors of another length than most in the sample; of rows with equal vec_id the least vector counts. An empty
    table gives an empty result."""
    spark = vectors.sparkSession
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where("vec_id is not null and x is not null").where(F.forall("x", finite) & F.exists("x", lambda v: v != 0))
    rows = written(rows.groupBy("vec_id").agg(F.min("x").alias("x")), "vectors")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], RESULT)
    sizes = np.bincount([len(v) for v in sample.column("x").to_pylist()])
    d = int(sizes.argmax())
    rows = rows.where(F.size("x") == d)
    n, asks, scale = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0), F.max(F.array_max(F.transform("x", F.abs)))).first()
    norm = rows.agg(F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + (v / scale) * (v / scale))))).first()[0]
    codes = fit(np.array([v for v in sample.column("x").to_pylist() if len(v) == d]), norm, scale)
    index_blocks, query_blocks = -(-n // INDEX_BLOCK), max(1, -(-asks // QUERY_BLOCK))
    mine = lambda blocks, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int")
    all_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    index = rows.select(mine(index_blocks, 1).alias("a"), all_of(query_blocks).alias("b"), F.lit(0).alias("asks"), "vec_id", "x")
    query = rows.where(F.col("vec_id") % every == 0).select(all_of(index_blocks).alias("a"), mine(query_blocks, 2).alias("b"), F.lit(1).alias("asks"), "vec_id", "x")
    shared = spark.sparkContext.broadcast(codes)  # a matrix of the dimensions by BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by group and kind."""
        key, parts = None, []

        def found() -> pa.RecordBatch:
            kind = np.concatenate([p[0] for p in parts])
            ids, x = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
            rows = list(_best(ids[kind == 0], x[kind == 0], ids[kind == 1], x[kind == 1], shared.value))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["query_id", "ids", "scores"])

        for b in batches:
            where = b.column(0).to_numpy().astype(np.int64) << 32 | b.column(1).to_numpy()
            x = b.column(4).flatten().to_numpy().reshape(-1, d)
            cuts = [0, *(np.flatnonzero(np.diff(where)) + 1), b.num_rows]
            for i, j in zip(cuts, cuts[1:], strict=False):
                if parts and where[i] != key:
                    yield found()
                    parts = []
                key = where[i]
                parts.append((b.column(2).to_numpy()[i:j], b.column(3).to_numpy()[i:j], x[i:j]))
        if parts:
            yield found()

    groups = index.unionByName(query).repartition(tasks(spark), "a", "b").sortWithinPartitions("a", "b", "asks")
    best = groups.mapInArrow(run, "query_id long, ids array<long>, scores array<double>")
    best = best.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit")).select("query_id", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def op7_ann_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op7_ann_mih": op7_ann_mih}
ORACLE_SQL: dict[str, str] = {}
