"""Operator 3 in rows: n-gram count tables joined to exploded n-grams, in DataFrame functions alone.

The score of a word depends on its n-gram alone, so each different n-gram is scored once:
S_1(w) = ln(c(w) / words); S_k = ln(c_k / c_{k-1}(its context)) if c_k >= cut, else ln(alpha) + S_{k-1}(without its first word).
Words are 64-bit hashes, last word first (w0, w1, ...); 0 stands before a text's first word. The count table of the longest n-grams is
written once, those of shorter ones are sums over it. Joins spread a hot word or n-gram over parts of its key.

This is what ``lm_scoring`` stands in for: every n-gram of every document is a row here, on disk in each exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalflow.llm.lm_scoring import ALPHA, CUT, ORDER
from loyalflow.llm.shared import spread_join, written

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"


def _exploded(rows: DataFrame, order: int) -> DataFrame:
    """doc_id, text_hash and w0, w1, ... of each place; the array of a text is shifted whole, not carried along."""
    words = F.regexp_extract_all(F.translate("text", *LOWER), F.lit(WORD), F.lit(0))
    rows = rows.select("doc_id", "text_hash", F.transform(words, lambda w: F.xxhash64(w)).alias("ws"))
    none = F.lit(0).cast("long")
    shifted = [F.concat(F.array_repeat(none, k), "ws").alias(f"w{k}") for k in range(order)]
    return rows.select("doc_id", "text_hash", F.inline(F.arrays_zip(*shifted))).where("w0 is not null")


def _scores(grams: DataFrame, order: int, alpha: float, cut: int) -> DataFrame:
    """w0, w1, ..., s from the counts ``n`` of the longest n-grams, those that a text's beginning cuts short among them."""
    names = [f"w{k}" for k in range(order)]
    all_words = F.broadcast(grams.agg(F.sum("n").alias("words")))  # one row
    counts = [grams.where(F.col(names[k - 1]) != 0).groupBy(*names[:k]).agg(F.sum("n").alias("n")) for k in range(1, order)]
    counts.append(grams.where(F.col(names[-1]) != 0))
    by_length = [counts[0].crossJoin(all_words).select("w0", F.log(F.col("n") / F.col("words")).alias("s"))]
    for k in range(2, order + 1):
        own = names[:k]
        context = counts[k - 2].select(*(F.col(a).alias(b) for a, b in zip(own, own[1:])), F.col("n").alias("before"))
        often = spread_join(counts[k - 1].where(F.col("n") >= cut), context, own[1:], F.col("w0"))
        seldom = spread_join(counts[k - 1].where(F.col("n") < cut), by_length[-1], own[:-1], F.col(own[-1]))
        by_length.append(often.select(*own, F.log(F.col("n") / F.col("before")).alias("s")).unionByName(seldom.select(*own, (F.col("s") + F.log(F.lit(alpha))).alias("s"))))
    none = F.lit(0).cast("long")
    return reduce(DataFrame.unionByName, (s.select(*(F.col(c) if c in s.columns else none.alias(c) for c in names), "s") for s in by_length))


def lm_scores_joined(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, cut: int = CUT) -> DataFrame:
    """What ``lm_scoring.lm_scores`` returns, by joins: one row per row of ``docs`` (doc_id, text; other columns are ignored) with n_words,
    log_score and mean_log_score. Null counts as an empty text; a text without words has 0, 0.0 and null; rows without an identifier, and
    repeated ones, are told apart by their texts and counted as often as they come. An empty table gives an empty result."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    places, names, key = _exploded(rows, order), [f"w{k}" for k in range(order)], ["doc_id", "text_hash"]
    grams = written(places.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "ngrams")
    scored = spread_join(places, _scores(grams, order, alpha, cut), names, F.col("text_hash"))
    sums = scored.groupBy(*key).agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"))
    copies = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    same: Column = reduce(Column.__and__, (F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key))
    out = copies.alias("d").join(sums.alias("s"), same, "left").select("d.doc_id", "copies", (F.coalesce("n", F.lit(0)) / F.col("copies")).cast("long").alias("n_words"), (F.coalesce("s.s", F.lit(0.0)) / F.col("copies")).alias("s"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    mean = F.when(F.col("n_words") > 0, F.round(F.col("s") / F.col("n_words"), 6))
    return out.select("doc_id", "n_words", F.round("s", 6).alias("log_score"), mean.alias("mean_log_score"))
