"""Physical layout of the order fact: partitioned by month, bucketed and sorted by member.

Aggregates by member, or by (partner, member), then read each bucket where it lies, without an exchange, and a filter on the date
reads only its months' folders. A bucket is one task's, when it is sorted and written and when it is aggregated. So there are as
many buckets as keep each at ``BUCKET_LINES`` lines or fewer, on average, however long the fact is. A member with a third of all
lines would be one task's too: members above ``HEAVY`` of the lines, or above half a bucket where that is less, found by a sketch,
and lines without a member are therefore kept in a second, unbucketed table, whose lines are aggregated the usual way: partial sums
in many tasks first.

The lines may come out of joins, and what a query shuffles stays on disk until it ends. So a long fact is written in rounds: the
orders are dealt out by a hash, and each round makes the lines of some and stages them by groups of buckets; then each round sorts
a group's lines into the tables. A round's shuffle files go when it ends, and a group's staged lines when they are in the tables.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from loyalflow.config import Program
from loyalflow.operators.joins import hot_keys
from loyalflow.operators.orders import level_metrics, metric_lines

MEMBER, MONTH = "crm_member_id", "month"
HEAVY = 0.01
#: Mean lines of a bucket; sorting or aggregating them takes some 300 MB of a task.
BUCKET_LINES = 1_000_000
#: There is a round for each ROUND_LINES lines, up to ROUNDS, as each reads the whole input that the lines come from. Groups of buckets: ROUNDS.
ROUNDS, ROUND_LINES = 8, 2_000_000
#: Spark's setting by which a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Layout:
    """Catalog tables of the fact: lines by bucket, and the lines of heavy members or of none."""

    bucketed: str
    heavy: str


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries made and run within leave no shuffle files."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_layout(orders: DataFrame, to: Layout, folder: str, buckets: int, heavy_share: float = HEAVY, bucket_lines: int = BUCKET_LINES,
                 round_lines: int = ROUND_LINES) -> None:
    """Write the fact into ``to``'s two tables (replaced if there), with their files in ``folder``.

    ``buckets`` is the least number: there are more where a bucket would have over ``bucket_lines`` lines on average, up to Spark's
    own limit, and as many in each group. Rows are dealt out by bucket and month first, so that each bucket has one file a month."""
    spark, staged = orders.sparkSession, f"{folder}/{to.bucketed}_staged"
    with shuffles_go(spark):
        rounds = _stage(orders, staged, round_lines)
        staged_lines = _staged(orders, staged)
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        lines = staged_lines.filter(F.col(MEMBER).isNotNull()).count()
        step = ROUNDS if rounds > 1 else 1
        buckets = max(buckets, min(most, step * math.ceil(max(buckets, lines / bucket_lines) / step)))
        share = min(heavy_share, 0.5 / buckets)
        found = f"{folder}/{to.heavy}_keys"  # all writes read it, so that it is found once
        hot_keys(staged_lines, [MEMBER], share).write.mode("overwrite").parquet(found)
        heavy = F.broadcast(spark.read.schema("_hot long").parquet(found))  # at most 2 / share rows
        marked = staged_lines.withColumns({MONTH: F.trunc("date_id", "MM").cast("date"), "_h": F.xxhash64(MEMBER)})
        marked = marked.join(heavy, F.col("_h") == F.col("_hot"), "left")
        marked = marked.withColumn("_apart", F.col("_hot").isNotNull() | F.col(MEMBER).isNull()).drop("_h", "_hot")
        for name in (to.bucketed, to.heavy):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for k in range(rounds):
            group, mode = marked.filter(F.col("_group") % rounds == k), "append" if k else "overwrite"
            some = group.filter(~F.col("_apart")).drop("_apart", "_group").repartition(buckets, MEMBER)
            some.sortWithinPartitions(MONTH, MEMBER).write.mode(mode).format("parquet").option("path", f"{folder}/{to.bucketed}") \
                .partitionBy(MONTH).bucketBy(buckets, MEMBER).sortBy(MEMBER).saveAsTable(to.bucketed)
            apart = group.filter("_apart").drop("_apart", "_group").hint("rebalance", MONTH)  # a month's lines in few files, however many
            apart.write.mode(mode).format("parquet").option("path", f"{folder}/{to.heavy}").partitionBy(MONTH).saveAsTable(to.heavy)
            for g in range(k, ROUNDS, rounds):
                _remove(spark, f"{staged}/_group={g}")
        _remove(spark, staged)


def round_of_order() -> Column:
    """Of the order alone: where lines are joined by it, a condition on this holds for both tables before they are shuffled."""
    return F.pmod(F.xxhash64("original_order_id"), F.lit(ROUNDS))


def _stage(orders: DataFrame, staged: str, round_lines: int) -> int:
    """Write all lines by ``_group``; the number of rounds, by the lines that the first part of the orders has.

    A group has whole buckets where their number is a multiple of the groups', and lines without a member are in all groups."""
    part = round_of_order()
    key = F.when(F.col(MEMBER).isNotNull(), F.hash(MEMBER)).otherwise(F.hash("original_order_id"))
    lines = orders.withColumn("_group", F.pmod(key, F.lit(ROUNDS)))

    def write(some: DataFrame, mode: str) -> None:
        some.write.mode(mode).option("compression", "zstd").partitionBy("_group").parquet(staged)

    write(lines.filter(part == 0), "overwrite")
    rounds = min(ROUNDS, max(1, math.ceil(_staged(orders, staged).count() * ROUNDS / round_lines)))
    further = max(1, rounds - 1)
    for k in range(further):
        write(lines.filter((part > 0) & (part % further == k)), "append")
    return rounds


def _staged(orders: DataFrame, staged: str) -> DataFrame:
    return orders.sparkSession.read.schema(StructType([*orders.schema, StructField("_group", IntegerType())])).parquet(staged)


def lines_before(spark: SparkSession, to: Layout, day: dt.date) -> DataFrame:
    """All lines dated before ``day``; months from then on are not listed, let alone read."""
    both = spark.table(to.bucketed).unionByName(spark.table(to.heavy))
    return both.filter((F.col(MONTH) <= F.trunc(F.lit(day), "MM")) & (F.to_date("date_id") < F.lit(day))).drop(MONTH)


def metrics(spark: SparkSession, to: Layout, program: Program) -> DataFrame:
    """``orders.member_order_single_pass`` over the layout: the bucketed lines' part has no exchange.

    A member is wholly in one of the two tables, so both levels' rows of the parts are simply put together."""
    parts = [level_metrics(metric_lines(spark.table(t), program)) for t in (to.bucketed, to.heavy)]
    return parts[0].unionByName(parts[1])
