"""Operator 3, LM scoring: stupid backoff over the whole corpus.

S(w | h) = c(h w) / c(h) if c(h w) >= CUT, else ALPHA * S(w | h without its first word); S(w) = c(w) / words. Counts are
over all documents.

Documents are dealt into chunks by a hash of identifier and text, so rows without an identifier are dealt out, too. A chunk explodes its n-grams of each order and sends the distinct ones with
their counts, packed as one row for each hash partition they belong to. A hash partition adds them up to its part of the
count tables and joins that back: each chunk gets the totals of the n-grams it sent, in their order. Then chunks
sum the scores of their documents. An n-gram that is everywhere is one number in each chunk's row, so no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.llm.shared import tasks
from loyalflow.llm.words import mix, words

ORDER, ALPHA, CUT = 3, 0.4, 2
#: Text of a chunk and n-grams of a hash partition, about: what one task holds. Larger ones make fewer and
#: better packed rows between them, which is what a corpus of many TB and executors with more memory ask for.
CHUNK_BYTES, PART_NGRAMS = 6_000_000, 4_000_000
#: Bits of a key beyond those that number the corpus' n-grams: the odds that another one shares an n-gram's key are 2 ** -SPARE.
SPARE, LEAST_BITS = 24, 48
SCHEMA = "doc_id long, n_words long, log_score double, mean_log_score double"


def _pack(x: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, so that high bytes, mostly zeros, pack well."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def _texts(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets of the rows)."""
    parts = list(words(column.combine_chunks()))
    offsets = np.concatenate([[0], *(np.diff(p.offsets) for p in parts)]).cumsum()
    return np.concatenate([p.hash for p in parts]) if parts else np.zeros(0, np.uint64), offsets


def _ngrams(hashes: np.ndarray, offsets: np.ndarray, order: int, bits: int) -> Iterator[np.ndarray]:
    """By order: the key of the n-gram that ends at each word; 2 ** bits where the text is too short for one."""
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1], np.diff(offsets))
    h = np.zeros(len(hashes), np.uint64)
    for n in range(1, order + 1):
        back = np.concatenate([np.zeros(n - 1, np.uint64), hashes[: len(hashes) - n + 1]])[: len(hashes)]
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + back + np.uint64(n))
        yield np.where(place >= n - 1, mix(h + np.uint64(n)) >> np.uint64(64 - bits), np.uint64(1 << bits) if bits < 64 else np.uint64((1 << 64) - 1))


def _edges(parts: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)


def lm_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, cut: int = CUT, chunk_bytes: int = CHUNK_BYTES, part_ngrams: int = PART_NGRAMS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored), whole texts: n_words, log_score (the sum of
    natural logarithms of S, rounded to 6 places) and mean_log_score (by word; null without words, as for a null text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    most = size // 2 * order + 2  # n-grams: a word and a blank take two bytes
    bits = min(64, max(LEAST_BITS, math.ceil(math.log2(most)) + SPARE))
    parts = max(1, size * order // 6 // part_ngrams)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // chunk_bytes)))).cast("int"))
    edges = _edges(parts, bits)
    kinds = [("chunk", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]

    def ask(t: pa.Table) -> pa.Table:
        hashes, offsets = _texts(t.column("text"))
        out = []
        for n, keys in enumerate(_ngrams(hashes, offsets, order, bits), 1):
            unique, counts = np.unique(keys, return_counts=True)
            cuts = [0, *np.searchsorted(unique, edges), len(unique)]
            out += [(t.column("chunk")[0].as_py(), p, n, _pack(np.diff(unique[a:b], prepend=np.uint64(0))), _pack(counts[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        return pa.Table.from_arrays([pa.array([r[k] for r in out], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by order and part: each asking chunk's totals."""
        key, asked = None, []

        def answer() -> pa.RecordBatch:
            each = [np.cumsum(_unpack(k)) for _, k, _ in asked]
            _, at = np.unique(np.concatenate(each), return_inverse=True)
            sums = np.bincount(at, np.concatenate([_unpack(c) for _, _, c in asked]))[at].astype(np.uint64)
            split = np.split(sums, np.cumsum([len(x) for x in each])[:-1])
            return pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in asked], pa.int32()), pa.array([key[1]] * len(asked), pa.int32()), pa.array([key[0]] * len(asked), pa.int32()), pa.array([_pack(x) for x in split], pa.binary())], ["chunk", "part", "n", "totals"])

        for b in batches:
            for chunk, part, n, keys, counts in zip(*(b.column(i) for i in range(5)), strict=True):
                if (n.as_py(), part.as_py()) != key:
                    if asked:
                        yield answer()
                    key, asked = (n.as_py(), part.as_py()), []
                asked.append((chunk.as_py(), keys.as_py(), counts.as_py()))
        if asked:
            yield answer()

    def score(t: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, offsets = _texts(t.column("text"))
        got = sorted(answers.select(["n", "part", "totals"]).to_pylist(), key=lambda r: (r["n"], r["part"]))
        per_word, context = np.zeros(len(hashes)), None
        for n, keys in enumerate(_ngrams(hashes, offsets, order, bits), 1):
            if not len(hashes):
                break
            totals = np.concatenate([_unpack(r["totals"]) for r in got if r["n"] == n]).astype(np.float64)
            count = totals[np.unique(keys, return_inverse=True)[1]]
            there = np.arange(len(hashes)) - np.repeat(offsets[:-1], np.diff(offsets)) >= n - 1
            if n == 1:
                per_word = np.log(count / all_words)
            else:
                before = np.concatenate([[1.0], context[:-1]])  # the count of the n-gram without its last word
                per_word = np.where(there, np.where(count >= cut, np.log(count / before), np.log(alpha) + per_word), per_word)
            context = count
        n_words = np.diff(offsets)
        by_row = np.add.reduceat(np.append(per_word, 0.0), np.minimum(offsets[:-1], len(per_word))) * (n_words > 0)
        mean = [round(x / n, 6) if n else None for x, n in zip(by_row.tolist(), n_words.tolist(), strict=True)]
        return pa.Table.from_arrays([t.column("doc_id"), pa.array(n_words), pa.array(np.round(by_row, 6)), pa.array(mean, pa.float64())], ["doc_id", "n_words", "log_score", "mean_log_score"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(w.hash) for w in words(b.column(0)))], pa.int64())], ["n"])

    all_words = rows.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 1
    asked = rows.groupBy("chunk").applyInArrow(ask, "chunk int, part int, n int, keys binary, counts binary")
    answers = asked.repartition(tasks(docs.sparkSession), "n", "part").sortWithinPartitions("n", "part").mapInArrow(total, "chunk int, part int, n int, totals binary")
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, SCHEMA)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_lm_scoring": op3_lm_scoring}
ORACLE_SQL = {
    "op3_lm_scoring": """
        WITH texts AS (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS ws
            FROM documents),
        single AS (SELECT row, unnest(ws) AS w3, generate_subscripts(ws, 1) AS i FROM texts),
        grams AS (SELECT row, i, w3, lag(w3) OVER p AS w2, lag(w3, 2) OVER p AS w1 FROM single WINDOW p AS (PARTITION BY row ORDER BY i)),
        c1 AS (SELECT w3, count(*) AS c FROM grams GROUP BY w3),
        c2 AS (SELECT w2, w3, count(*) AS c FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
        c3 AS (SELECT w1, w2, w3, count(*) AS c FROM grams WHERE w1 IS NOT NULL GROUP BY ALL),
        scored AS (
            SELECT g.row, ln(CASE
                WHEN g.w1 IS NOT NULL AND c3.c >= 2 THEN c3.c / h2.c
                WHEN g.w2 IS NOT NULL AND c2.c >= 2 THEN CASE WHEN g.w1 IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END * c2.c / h1.c
                ELSE CASE WHEN g.w2 IS NULL THEN 1.0::DOUBLE WHEN g.w1 IS NULL THEN 0.4::DOUBLE ELSE 0.4::DOUBLE * 0.4::DOUBLE END * c1.c / (SELECT count(*) FROM single)
                END) AS s
            FROM grams g JOIN c1 ON c1.w3 = g.w3
            LEFT JOIN c2 ON c2.w2 = g.w2 AND c2.w3 = g.w3
            LEFT JOIN c3 ON c3.w1 = g.w1 AND c3.w2 = g.w2 AND c3.w3 = g.w3
            LEFT JOIN c1 h1 ON h1.w3 = g.w2
            LEFT JOIN c2 h2 ON h2.w2 = g.w1 AND h2.w3 = g.w2)
        SELECT t.doc_id, len(any_value(t.ws))::BIGINT AS n_words, round(coalesce(sum(s), 0.0), 6) AS log_score, round(sum(s) / nullif(len(any_value(t.ws)), 0), 6) AS mean_log_score
        FROM texts t LEFT JOIN scored s ON t.row = s.row GROUP BY t.row, t.doc_id
    """,
}
