"""Order metrics from the state by day."""

from __future__ import annotations

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.operators import orders as O
from loyalflow.plans import daily_state
from tests.conftest import rows
from tests.test_orders import SCHEMA, line

D = dt.date


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="loyalflow-state-")


def on(day, *args, **more):
    """An order line of a day."""
    made = list(line(*args, **more))
    made[4] = day
    return tuple(made)


def test_condensed_lines_give_the_same_levels(small_src):
    o = small_src.orders
    state = O.condensed_lines(o, P)
    assert rows(O.level_metrics(state)) == rows(O.member_order_single_pass(o, P))
    parts = [o.filter(F.pmod(F.xxhash64("sku_id", "original_store_code"), F.lit(3)) == k) for k in range(3)]  # orders are cut apart
    merged = O.condensed_lines(parts[0], P).unionByName(O.condensed_lines(parts[1], P)).unionByName(O.condensed_lines(parts[2], P))
    assert rows(O.level_metrics(merged)) == rows(O.member_order_single_pass(o, P))


def test_three_days_one_restated_equal_the_full_refresh(spark, root):
    d1, d2, d3 = D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)
    old = [
        on(d1, "1", "CHN D (D1)", "o1", None, "1", "10.00"), on(d1, "1", "CHN E (E1)", "o1", None, "1", "3.00"),
        on(d1, None, "CHN D (D1)", "o7", None, "1", "1.00"), on(d1, "2", None, "o8", None, "1", "4.00", eff=None),
        on(None, "1", "CHN D (D1)", "o9", None, "2", "6.00"),
    ]
    second = [on(d2, "1", "CHN D (D1)", "o1", None, "-1", "-10.00"), on(d2, "3", "CHN D (D1)", "o2", None, "1", "5.00")]
    third = [on(d3, "3", "CHN D (D1)", "o3", None, "1", "5.50"), on(d3, "3", "CHN D (D1)", "o2", None, "1", "0.50", eff=False)]
    restated = [on(d2, "4", "CHN D (D1)", "o2", None, "1", "5.00")]  # the day's lines belong to another member now

    def table(*parts):
        return spark.createDataFrame([x for p in parts for x in p], SCHEMA)

    def same(fact):
        assert rows(daily_state.metrics(spark, root)) == rows(O.member_order_single_pass(fact, P))

    assert rows(daily_state.metrics(spark, root)) == []
    daily_state.apply_days(spark, table(old), P, root)
    same(table(old))
    daily_state.apply_days(spark, table(old, second), P, root, [d2])
    same(table(old, second))
    fact = table(old, second, third)
    assert daily_state.apply_days(spark, fact, P, root, [d3]) == [d3.isoformat()]
    daily_state.apply_days(spark, fact, P, root, [d3])  # once more: nothing counts twice
    same(fact)
    fact = table(old, restated, third)
    daily_state.apply_days(spark, fact, P, root, [d2])
    same(fact)
    fact = table(third)
    assert daily_state.apply_days(spark, fact, P, root, [d1, d2, None]) == []  # days that have lost all their lines
    same(fact)
    assert set(daily_state.applied_days(spark, root)) == {"2024-01-01", "2024-01-02", "2024-01-03", daily_state.UNDATED}


def test_a_refresh_that_breaks_changes_nothing(spark, root):
    day = D(2024, 1, 1)
    good = spark.createDataFrame([on(day, "1", "CHN D (D1)", "o1", None, "1", "10.00")], SCHEMA)
    daily_state.apply_days(spark, good, P, root)
    before = rows(daily_state.metrics(spark, root))
    with pytest.raises(Exception, match="lost disk"):
        daily_state.apply_days(spark, good.withColumn("sales_qty", F.raise_error(F.lit("lost disk")).cast("decimal(18,2)")), P, root, [day])
    assert rows(daily_state.metrics(spark, root)) == before


def test_a_refresh_reads_the_fact_of_its_days_only(spark, small_src, root):
    folder = tempfile.mkdtemp(prefix="loyalflow-fact-")
    small_src.orders.withColumn("part", F.date_format("date_id", "yyyy")).write.mode("overwrite").partitionBy("part").parquet(folder)
    fact = spark.read.parquet(folder)
    days = [D(2000, 1, 1), D(2000, 1, 2)]
    plan = fact.filter(F.to_date("date_id").isin([F.lit(d) for d in days]))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(date_id" in plan or "PushedFilters: [" in plan and "date_id" in plan.split("PushedFilters")[1][:200]


def test_backfill_equals_single_runs(spark, small_src, root):
    daily_state.apply_days(spark, small_src.orders, P, root)
    dates = [D(1995, 1, 1), D(1996, 7, 1), D(1998, 3, 5), D(2030, 1, 1)]
    got = daily_state.metrics_as_of(daily_state.read_state(spark, root), dates)
    for day in dates:
        seen = small_src.orders.filter(F.to_date("date_id") < F.lit(day))
        want = O.member_order_single_pass(seen, P).drop("has_eff", "has_belong")
        one = got.filter(F.col("run_date") == F.lit(day)).drop("run_date")
        assert rows(one.select(*want.columns)) == rows(want)
    assert got.filter("run_date = DATE'1995-01-01'").count() == 0
