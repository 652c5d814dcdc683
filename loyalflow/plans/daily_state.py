"""Order metrics from a state by day: a refresh reads only the days that changed.

The state holds order lines condensed to one row for each (day, partner, member, order). Applying days reads the fact's lines of
those days alone, writes them as a new version, and then points the days to it with one numbered manifest, as
``plans.publish`` does. A restated day thus replaces what it was before, and a refresh that dies changes nothing. The
metrics are the same aggregates over the state as over the lines, so they are equal bit for bit. A version holds as many
files as its rows need, whatever the number of days; rows of a day that a later version holds are left out by a
broadcast of (day, version), one row for each day.

The same state answers for many run dates at once: ``metrics_as_of`` adds up days, and joins dates to the sums.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.operators.orders import LINE_STATE, SALES_TYPE, condensed_lines, level_metrics
from loyalflow.plans.publish import Store

#: The day of lines without a date, in manifests.
UNDATED = "undated"


def applied_days(spark: SparkSession, root: str) -> dict[str, str]:
    """The version that holds each applied day's lines, by ISO date."""
    store = Store(spark, root)
    last = [n for n in store.names("manifests") if n.endswith(".json")][-1:]
    return json.loads(store.read(f"manifests/{last[0]}")) if last else {}


def apply_days(spark: SparkSession, orders: DataFrame, program: Program, root: str,
               days: Sequence[dt.date | None] | None = None) -> list[str]:
    """Take the given days' lines (None among them: lines without a date) into the state, in place of what it holds of them.

    ``days`` None: every day that the fact has, as a first load. Returns the days that have lines."""
    store, before = Store(spark, root), applied_days(spark, root)
    number = len([n for n in store.names("manifests") if n.endswith(".json")])
    if days is not None:
        dated = [F.lit(d) for d in days if d is not None]
        wanted = F.to_date("date_id").isin(dated) if dated else F.lit(False)
        orders = orders.filter(wanted | F.col("date_id").isNull() if None in days else wanted)
    version = uuid.uuid4().hex
    condensed_lines(orders, program, [F.to_date("date_id").alias("day")]).write.parquet(f"{store.root}/state/version={version}")
    found = [UNDATED if r["day"] is None else r["day"].isoformat() for r in _rows(spark, store.root, [version]).select("day").distinct().collect()]
    named = found if days is None else [UNDATED if d is None else d.isoformat() for d in days]
    after = (before if days is not None else {}) | {d: version for d in named}
    if not store.create(f"manifests/{number:08d}.json", json.dumps(after)):
        raise RuntimeError("another refresh was applied meanwhile; apply the days again")
    return sorted(found)


def _rows(spark: SparkSession, root: str, versions: list[str]) -> DataFrame:
    schema = f"day date, {LINE_STATE}, version string"
    return spark.read.schema(schema).option("basePath", f"{root}/state").parquet(*(f"{root}/state/version={v}" for v in versions))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """LINE_STATE and ``day`` (null for lines without a date) of the applied days."""
    root, applied = root.rstrip("/"), applied_days(spark, root)
    if not applied:
        return spark.createDataFrame([], f"day date, {LINE_STATE}")
    live = spark.createDataFrame([(None if d == UNDATED else dt.date.fromisoformat(d), v) for d, v in applied.items()], "_day date, _version string")
    rows = _rows(spark, root, sorted(set(applied.values())))
    held = F.col("day").eqNullSafe(F.col("_day")) & (F.col("version") == F.col("_version"))
    return rows.join(F.broadcast(live), held, "left_semi").drop("version")


def metrics(spark: SparkSession, root: str) -> DataFrame:
    """The columns of ``orders.member_order_single_pass`` from the applied days, without reading the fact."""
    return level_metrics(read_state(spark, root))


def _running(state: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of each key up to and with each of its days; an order counts on its first day."""
    firsts = state.filter(F.col("original_order_id").isNotNull()).groupBy(*keys, "original_order_id").agg(F.min("day").alias("day"))
    none = {c: F.lit(None).cast(t) for c, t in (("_eff", "boolean"), ("_in", "decimal(38,2)"), ("_out", "decimal(38,2)"), ("_belong_dt", "date"))}
    rows = state.select(*keys, "day", *none.keys(), F.lit(0).cast("long").alias("_new")).unionByName(
        firsts.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("_new")).withColumns(none))
    days = rows.groupBy(*keys, "day").agg(F.bool_or("_eff").alias("_eff"), *(F.sum(c).alias(c) for c in ("_in", "_out", "_new")), F.min("_belong_dt").alias("_belong_dt"))
    so_far = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(
        *keys, "day", F.lead("day").over(Window.partitionBy(*keys).orderBy("day")).alias("_until"),
        F.bool_or("_eff").over(so_far).alias("has_eff"), F.sum("_new").over(so_far).alias("_orders"),
        (F.sum("_in").over(so_far) - F.sum("_out").over(so_far)).cast(SALES_TYPE).alias("mbr_sales"),
        F.min("_belong_dt").over(so_far).alias("belong_dt"))


def metrics_as_of(state: DataFrame, run_dates: Sequence[dt.date]) -> DataFrame:
    """run_date, level, partner, crm_member_id, order_count, mbr_sales, belong_dt: what a run on each date would have found, with
    the lines dated before it. Every key appears from its first day on. ``state``: as of ``read_state``."""
    dates: Column = F.array(*(F.lit(d) for d in sorted(set(run_dates)))).cast("array<date>")

    def level(name: str, keys: list[str]) -> DataFrame:
        sums = _running(state.filter(F.col("day").isNotNull()), keys)
        valid = F.filter(dates, lambda d: (d > F.col("day")) & (F.col("_until").isNull() | (d <= F.col("_until"))))
        partner = F.col("partner") if "partner" in keys else F.lit(None).cast("string")
        return sums.withColumn("run_date", F.explode(valid)).select(
            "run_date", F.lit(name).alias("level"), partner.alias("partner"), "crm_member_id",
            F.when(F.col("has_eff"), F.col("_orders")).alias("order_count"), "mbr_sales", "belong_dt")

    return level("partner", ["partner", "crm_member_id"]).unionByName(level("member", ["crm_member_id"]))
