"""A fixed-size filter of keys, applied to a large table before its wide columns move."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits and bits set for each key. The word table has at most WORDS rows of 16 bytes (about 50 MB as a hash relation),
#: however many keys there are, so it may always be broadcast. Up to WORDS * 4 keys, fewer than 1 % of other rows pass;
#: with more keys more of them do, and nothing else changes: no row of a key is ever lost.
WORDS, BITS = 1 << 20, 4


def _word(cols: list[Column], words: int) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit(words - 1))


def _mask(cols: list[Column]) -> Column:
    """BITS of a word, taken from the upper half of the key's hash."""
    h = F.xxhash64(*cols)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, 40 + 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(BITS)]
    return reduce(Column.bitwiseOR, bits)


def key_filter(keys: DataFrame, cols: list[Column], words: int = WORDS) -> DataFrame:
    """(word, bits) of the keys ``cols``: a blocked Bloom filter, as one hash aggregate of fixed-width values.

    ``words``: a power of two."""
    return keys.select(_word(cols, words).alias("word"), _mask(cols).alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def maybe_among(df: DataFrame, cols: list[Column], keys: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of ``df`` whose ``cols`` are in ``key_filter``'s keys, and few others; a NULL equals a NULL. Nothing is shuffled."""
    table = F.broadcast(keys.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    marked = df.withColumns({"_word": _word(cols, words), "_mask": _mask(cols)})
    return marked.join(table, "_word").filter(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).drop("_word", "_bits", "_mask")
