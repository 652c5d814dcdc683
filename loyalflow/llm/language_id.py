"""Operator 4, language ID: language-bitmask n-gram filters.

Training keeps, for each language, the byte n-grams that are frequent in it and not much more frequent in another one.
They go into one bit-sliced Bloom filter: a slot holds one bit per language, so the AND of an n-gram's few slots gives all
languages that contain it at once. A text's language is that with most n-grams, after taking off those that the
filter's known rate of false positives explains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.llm.shared import written
from loyalflow.llm.words import buffers, mix, slices

#: Fit: documents of each language, about so many by a hash (and all of a smaller one); the least share of a language's n-grams that one needs, so
#: that a language has 1 / LEAST n-grams at most; and the least part of its largest share in any language.
SAMPLE, LEAST, PART = 4000, 2e-5, 0.25
BROADCAST_ROWS = 200_000
GRAM, SLOT_BITS, HASHES = 5, 20, 3
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123], _LETTER[128:] = np.arange(97, 123), np.arange(128, 256)
_PAD, _NONE = pa.scalar("  ", pa.large_string()), pa.scalar("", pa.large_string())
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def _grams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, n-grams) in slices: each row's runs of GRAM bytes of lower-cased letters, padded with blanks."""
    padded = pc.binary_join_element_wise(_PAD, pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), _PAD, _NONE)
    offsets, data = buffers(padded)
    for a, b in slices(offsets):
        text = _LETTER[data[offsets[a] : offsets[b]]].astype(np.uint64)
        cut = offsets[a : b + 1] - offsets[a]
        gram = np.zeros(max(0, len(text) - GRAM + 1), np.uint64)
        for k in range(GRAM):
            gram |= text[k : k + len(gram)] << np.uint64(8 * k)
        inside = np.ones(len(text), bool)
        for k in range(GRAM - 1):  # rows have 4 bytes at least
            inside[cut[1:] - 1 - k] = False
        counts = np.diff(cut) - (GRAM - 1)
        yield a, np.concatenate([[0], np.cumsum(counts)]), gram[inside[: len(gram)]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n-gram, count) of each slice of a batch's texts."""
    for b in batches:
        langs = np.array(b.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            for _, _, grams in _grams(b.column(1).filter(pa.array(langs == lang))):
                g, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])


@dataclass
class Model:
    langs: list[str]
    slots: np.ndarray  # (2 ** SLOT_BITS, bytes of the language mask)
    false: np.ndarray  # by language: the share of foreign n-grams that seem to be in its filter
    usual: str | None  # the most frequent language, for texts without any known n-gram


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    h = mix(grams)
    return [((h >> np.uint64(SLOT_BITS * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


def fit(training: DataFrame, sample: int = SAMPLE) -> Model:
    """training: doc_id, text, lang. Rows with a null text or lang take no part; about ``sample`` rows of a language do."""
    rows = training.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("all"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = rows.select("lang", "doc_id").join(known, "lang").where(part < F.lit(sample) / F.col("all")).select("doc_id").distinct()
    picked = written(picked, "picked")
    if picked.count() <= BROADCAST_ROWS:
        picked = F.broadcast(picked)
    grams = rows.join(picked, "doc_id", "left_semi").select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = Window.partitionBy("lang")
    shares = grams.withColumn("share", F.col("n") / F.sum("n").over(total)).where(F.col("share") >= LEAST)
    shares = shares.withColumn("top", F.max("share").over(Window.partitionBy("gram"))).where(F.col("share") >= PART * F.col("top"))
    found = shares.select("lang", "gram", "n").toArrow().to_pandas()  # 1 / LEAST rows a language at most
    langs = sorted(found["lang"].unique())
    slots = np.zeros((1 << SLOT_BITS, max(1, -(-len(langs) // 8))), np.uint8)
    for i, lang in enumerate(langs):
        for s in _slots(found.loc[found["lang"] == lang, "gram"].to_numpy().astype(np.uint64)):
            slots[s, i // 8] |= np.uint8(1 << i % 8)
    fill = np.array([(slots[:, i // 8] >> (i % 8) & 1).mean() for i in range(len(langs))])
    usual = max(langs, key=lambda x: (found.loc[found["lang"] == x, "n"].sum(), x), default=None)
    return Model(langs, slots, fill**HASHES, usual)


def predict(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text: the language's part of all languages' corrected counts."""
    counts = np.zeros((len(column), len(model.langs)))
    total = np.zeros(len(column))
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    for first, offsets, grams in _grams(column) if model.langs else ():
        rows, n = len(offsets) - 1, np.diff(offsets)
        row = np.repeat(np.arange(rows), n)
        a, *more = _slots(grams)
        mask = model.slots[a]
        for s in more:
            mask = mask & model.slots[s]
        total[first : first + rows] = n
        for w in range(mask.shape[1]):
            seen = np.bincount(row * 256 + mask[:, w], minlength=rows * 256).reshape(rows, 256) @ bits
            own = slice(8 * w, min(8 * w + 8, len(model.langs)))
            counts[first : first + rows, own] = seen[:, : own.stop - own.start]
    letter = np.array(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}").fill_null(False))
    real = np.maximum(0, (counts - total[:, None] * model.false) / np.maximum(1e-9, 1 - model.false)) if model.langs else counts
    best = real.argmax(axis=1) if model.langs else np.zeros(len(column), int)
    top = real[np.arange(len(column)), best] if model.langs else np.zeros(len(column))
    lang = ["und" if not ok or not model.langs else model.langs[b] if x > 0 else model.usual for ok, b, x in zip(letter, best, top, strict=True)]
    return lang, np.where(letter & (top > 0), top / np.maximum(1e-9, real.sum(axis=1)), 0.0)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text; other columns are ignored), whole texts.

    ``und`` with score 0 for null texts and those without a letter, and where nothing could be learned; ties go to the
    first language by name; texts without any known n-gram get the most frequent language with score 0.
    """
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** SLOT_BITS slots, whatever the input's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = predict(shared.value, b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(docs, fit(docs.where("crc32(cast(doc_id as string)) % 5 <> 0")))


QUERIES = {"op4_language_id": op4_language_id}
ORACLE_SQL: dict[str, str] = {}
