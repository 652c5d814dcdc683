"""Join helpers."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets for each shuffle partition, so that the buckets of NULL keys, or of a heavy key, fall evenly.
BUCKETS_PER_PARTITION = 16


def left_join_spread_nulls(left: DataFrame, rights: DataFrame | list[DataFrame], keys: list[str],
                           spread: list[str], buckets: int | None = None) -> DataFrame:
    """LEFT JOIN ``left`` to each of ``rights`` on equal-named ``keys``.

    A shuffled outer join hashes every NULL key to the same partition, and NULL keys are
    common here (list phones with no member), so one task would get them all.  Both
    sides get an extra join key ``_nb``: the key's own hash bucket, except for left rows
    with a NULL key, which take a bucket from the ``spread`` columns.  Equal keys still
    meet (same bucket on both sides); NULL keys still match nothing; the NULL group is
    cut into ``buckets`` pieces.  One pass, no sentinel values, nothing recomputed.

    Several right sides on the same keys share one ``_nb``, so the left side is shuffled
    once for all of them.
    """
    if buckets is None:
        buckets = BUCKETS_PER_PARTITION * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if isinstance(rights, DataFrame):
        rights = [rights]
    any_null = _any_null(keys)
    own = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))
    alt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(buckets))
    out = left.withColumn("_nb", F.when(any_null, alt).otherwise(own))
    for right in rights:
        out = out.join(right.filter(~any_null).withColumn("_nb", own), keys + ["_nb"], "left")
    return out.drop("_nb")


def hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Hashes (``_hot``) of the keys that hold at least ``share`` of the rows, a few lighter ones perhaps among them.

    A frequent-items sketch finds them in one pass over the key columns, without a shuffle of keys: at most 2 / share rows come
    out, whatever the table's size, so they may be broadcast. Keys with a NULL are left out.
    """
    k = math.ceil(2 / share)
    hashed = df.filter(~_any_null(keys)).select(F.xxhash64(*keys).alias("h"))
    top = hashed.agg(F.call_function("approx_top_k", F.col("h"), F.lit(k), F.lit(min(1_000_000, 16 * k))).alias("top"), F.count(F.lit(1)).alias("n"))
    found = top.select(F.explode("top").alias("t"), "n").filter(F.col("t.count") >= F.lit(share) * F.col("n"))
    return found.select(F.col("t.item").alias("_hot"))


def left_join_spread_hot(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], share: float = 0.01,
                         salts: int | None = None) -> DataFrame:
    """LEFT JOIN in which neither NULL keys nor keys with more than ``share`` of the left rows gather in one task.

    ``hot_keys`` finds the heavy keys. Only their left rows are salted, by the ``spread`` columns, and only their right rows are
    repeated, once for each salt; all other rows join as they would. NULL keys go by ``left_join_spread_nulls``.
    """
    if salts is None:
        salts = BUCKETS_PER_PARTITION * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, keys, share))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(salts)).cast("int")
    zero = F.lit(0)

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_h", F.xxhash64(*keys)).join(hot, F.col("_h") == F.col("_hot"), "left").drop("_h")

    rows = marked(left).withColumn("_salt", F.when(F.col("_hot").isNotNull() & ~_any_null(keys), salt).otherwise(zero)).drop("_hot")
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(zero, F.lit(salts - 1))).otherwise(F.array(zero))
    facts = marked(right.filter(~_any_null(keys))).withColumn("_salt", F.explode(copies)).drop("_hot")
    return left_join_spread_nulls(rows, facts, [*keys, "_salt"], spread).drop("_salt")


def left_join_spread(left: DataFrame, rights: DataFrame | list[DataFrame], keys: list[str], spread: list[str],
                     hot_share: float | None = None) -> DataFrame:
    """LEFT JOIN with spread NULL keys, and with spread heavy keys where ``hot_share`` says from which share of rows on."""
    if hot_share is None:
        return left_join_spread_nulls(left, rights, keys, spread)
    rights = [rights] if isinstance(rights, DataFrame) else rights
    return reduce(lambda df, right: left_join_spread_hot(df, right, keys, spread, hot_share), rights, left)


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
