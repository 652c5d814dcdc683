"""Hot keys, filters of keys, rejected ids, dated snapshots."""

from __future__ import annotations

import datetime as dt
import os
import re
import tempfile
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.operators import orders as O
from loyalflow.operators.filters import key_filter, maybe_among
from loyalflow.operators.joins import hot_keys, left_join_spread_hot
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import historical_base_flags
from loyalflow.sources import catalog, layout, rejects, snapshots
from tests.conftest import rows
from tests.test_orders import SCHEMA, line


@pytest.fixture()
def plain_joins(spark):
    """No broadcasts and no runtime changes: partitions are those that the keys ask for."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    spark.conf.set("spark.sql.adaptive.enabled", True)


# ---- hot keys

def test_a_phone_with_a_third_of_the_rows_is_spread(spark, plain_joins):
    left = spark.range(0, 60_000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('p', id) end k", "id % 7919 a", "id b")
    right = spark.range(0, 60_000, 7).selectExpr("concat('p', id) k", "id v").union(spark.sql("select 'hot', 1L union all select 'hot', 2L union all select null, 3L"))
    assert hot_keys(left, ["k"], 0.01).count() >= 1
    got = left_join_spread_hot(left, right, ["k"], ["a", "b"])
    assert rows(got.select("k", "a", "b", "v")) == rows(left.join(right, "k", "left").select("k", "a", "b", "v"))
    sizes = sorted(r["n"] for r in got.selectExpr("spark_partition_id() p").groupBy("p").agg(F.count("*").alias("n")).collect())
    assert max(sizes) < 2 * sizes[len(sizes) // 2]
    worst = sorted(r["n"] for r in left.join(right, "k", "left").selectExpr("spark_partition_id() p").groupBy("p").agg(F.count("*").alias("n")).collect())
    assert max(worst) > 5 * worst[len(worst) // 2]


def test_few_keys_are_hot_and_none_may_be(spark):
    left = spark.range(0, 20_000).selectExpr("case when id % 3 = 0 then -1 else id end k", "id s")
    hot = {r["_hot"] for r in hot_keys(left, ["k"], 0.05).collect()}
    assert left.where("k = -1").select(F.xxhash64("k").alias("h")).first()["h"] in hot and len(hot) <= 40
    assert hot_keys(left.limit(0), ["k"], 0.05).count() == 0
    right = spark.createDataFrame([(5, "x")], "k long, v string")
    got = left_join_spread_hot(left.limit(0), right, ["k"], ["s"])
    assert got.count() == 0


def test_hot_pairs_of_keys(spark):
    left = spark.range(0, 5_000).selectExpr("case when id % 2 = 0 then 1 else id end k", "if(id % 4 = 1, null, 'p') p", "id s")
    right = spark.createDataFrame([(1, "p", "x"), (1, "q", "y"), (3, None, "n"), (7, "p", "z"), (7, "p", "zz")], "k long, p string, v string")
    got = left_join_spread_hot(left, right, ["k", "p"], ["s"])
    assert rows(got.select("k", "p", "s", "v")) == rows(left.join(right, ["k", "p"], "left").select("k", "p", "s", "v"))


# ---- filters of keys

def test_a_filter_drops_no_key_and_few_rows_pass(spark):
    keys = spark.range(0, 40_000).selectExpr("cast(id * 7 as string) k", "if(id % 5 = 0, null, id) t")
    pair = [F.col("k"), F.col("t")]
    table = key_filter(keys, pair, 1 << 14)
    assert table.count() <= 1 << 14
    assert maybe_among(keys, pair, table, 1 << 14).count() == 40_000
    others = spark.range(0, 200_000).selectExpr("cast(id * 7 + 1 as string) k", "id t")
    assert maybe_among(others, pair, table, 1 << 14).count() < 2_000
    full = key_filter(keys, pair, 1 << 4)  # far too small: everything passes, nothing is lost
    assert full.count() <= 1 << 4 and maybe_among(keys, pair, full, 1 << 4).count() == 40_000
    assert maybe_among(others, pair, key_filter(keys.limit(0), pair)).count() == 0


def test_the_filter_stands_below_the_wide_exchange(spark, small_src):
    plan = O.last_order_details(small_src.orders, small_src.store, P)._jdf.queryExecution().executedPlan().toString()
    wide = plan[plan.index("sku_name"):]
    assert "BroadcastHashJoin [_word" in wide
    for exchange in re.finditer(r"Exchange hashpartitioning\(partner#\d+, original_order_id#\d+", plan):
        below = plan[exchange.end() : exchange.end() + 3000]
        if "sku_name" in below.split("Exchange")[0]:
            assert "_bits" in below.split("Exchange")[0]
            break
    else:
        raise AssertionError("no wide exchange found")


def test_exchanged_lines_are_those_of_winning_orders(spark, small_src):
    winners = O.last_order_ranked(small_src.orders, P).select("partner", "original_order_id").distinct()
    lines = O.rrp_lines(small_src.orders).filter(O.eff_line()).withColumn("partner", O.partner_col(P))
    key = [F.col("partner"), F.col("original_order_id")]
    passed = maybe_among(lines, key, key_filter(winners, key)).count()
    needed = lines.join(winners, ["partner", "original_order_id"], "left_semi").count()
    assert needed <= passed <= 1.05 * needed


def test_the_ranking_sorts_no_lines(spark, small_src):
    plan = O.last_order_ranked(small_src.orders, P)._jdf.queryExecution().executedPlan().toString()
    first = plan.index("hashpartitioning(partner")
    lowest = plan.rindex("HashAggregate(keys=[partner")
    assert first < lowest and "SortAggregate" not in plan
    # below each exchange that reads the lines, there are hash aggregates and no sort or window
    for part in plan.split("hashpartitioning(partner")[1:]:
        own = part.split("Scan parquet")[0].split("hashpartitioning")[0]
        if "partial_max" in own or "partial_bool_or" in own:
            assert "Sort [" not in own and "WindowGroupLimit" not in own


def test_ties_and_orders_without_a_paid_time(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", None, "1", "1.00"), line("1", "CHN D (D1)", "o1", t(2024, 1, 1), "1", "1.00"),
        line("1", "CHN D (D1)", "o0", None, "1", "1.00"), line("1", "CHN D (D1)", None, None, "1", "1.00"),
        line("2", "CHN D (D1)", "o9", t(2021, 1, 1), "1", "1.00"), line("2", "CHN D (D1)", "o10", t(2021, 1, 1), "1", "1.00"),
        line("2", "CHN E (E1)", "o3", t(2020, 1, 1), "1", "1.00"), line("3", None, "o4", t(2020, 1, 1), "1", "1.00"),
        line("4", "CHN D (D1)", None, t(2020, 1, 1), "1", "1.00"),
    ], SCHEMA)
    got = rows(O.last_order_ranked(df, P), "crm_member_id", "partner", "original_order_id", "order_paid_time")
    assert got == [
        ("1", "CHN D (D1)", "o1", None), ("2", "CHN D (D1)", "o9", t(2021, 1, 1)), ("2", "CHN E (E1)", "o3", t(2020, 1, 1)),
        ("3", None, "o4", t(2020, 1, 1)), ("4", "CHN D (D1)", None, t(2020, 1, 1)),
    ]


# ---- layout

def test_bucketed_lines_need_no_exchange(spark, small_src, plain_joins):
    folder = tempfile.mkdtemp(prefix="loyalflow-layout-")
    to = layout.Layout("t_lines", "t_heavy_lines")
    heavy = small_src.orders.filter(F.pmod(F.xxhash64("original_order_id"), F.lit(3)) == 0).withColumn("crm_member_id", F.lit("7"))
    fact = small_src.orders.unionByName(heavy)
    layout.write_layout(fact, to, folder, buckets=4, heavy_share=0.05)
    try:
        assert spark.table("t_heavy_lines").filter("crm_member_id is not null").select("crm_member_id").distinct().count() == 1
        assert spark.table("t_lines").filter("crm_member_id is null or crm_member_id = '7'").count() == 0
        got = layout.metrics(spark, to, P)
        want = O.member_order_single_pass(fact, P)
        assert rows(got.select(*want.columns)) == rows(want)
        plan = O.level_metrics(O.metric_lines(spark.table("t_lines"), P))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        sizes = [r["n"] for r in spark.table("t_lines").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        before = layout.lines_before(spark, to, dt.date(1996, 3, 5))
        assert before.count() == fact.filter("to_date(date_id) < DATE'1996-03-05'").count()
        scans = before._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*month", scans)
    finally:
        for t in ("t_lines", "t_heavy_lines"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_longer_fact_has_more_buckets_not_larger_ones(spark, plain_joins):
    to = layout.Layout("t_long_lines", "t_long_heavy_lines")
    for members, buckets in ((60, 4), (300, 16)):
        made = [line(str(m), "CHN D (D1)" if k % 2 else None, f"o{m}-{k // 2}", None, "1", "1.00") for m in range(members) for k in range(20)]
        if members == 300:  # 'big' has 4 % of the lines: less than the share given, more than half a bucket
            made += [line("big", "CHN D (D1)", f"o{k}", None, "1", "1.00") for k in range(250)]
            made += [line(None, "CHN D (D1)", f"n{k}", None, "1", "1.00") for k in range(50)]
        fact = spark.createDataFrame(made, SCHEMA)
        layout.write_layout(fact, to, tempfile.mkdtemp(prefix="loyalflow-layout-"), buckets=4, heavy_share=0.05, bucket_lines=400)
        try:
            plan = O.level_metrics(O.metric_lines(spark.table(to.bucketed), P))._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and f"SelectedBucketsCount: {buckets} out of {buckets}" in plan
            bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1)
            assert max(r["n"] for r in spark.table(to.bucketed).groupBy(bucket).agg(F.count("*").alias("n")).collect()) < 2 * 400
            apart = {r[0] for r in spark.table(to.heavy).select("crm_member_id").distinct().collect()}
            assert apart == ({None, "big"} if members == 300 else set())
            want = O.member_order_single_pass(fact, P)
            assert rows(layout.metrics(spark, to, P).select(*want.columns)) == rows(want)
        finally:
            for t in (to.bucketed, to.heavy):
                spark.sql(f"DROP TABLE IF EXISTS {t}")


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(k).getPath() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}


def test_a_long_fact_is_written_in_rounds_that_leave_no_shuffle_files(spark, small_src, monkeypatch):
    folder, to = tempfile.mkdtemp(prefix="loyalflow-layout-"), layout.Layout("t_round_lines", "t_round_heavy_lines")
    more = [line(m, "CHN D (D1)", o, None, "1", "1.00") for m, o in [("big", "o1"), ("big", "o2"), ("7", None), (None, "o3"), (None, None)] for _ in range(300)]
    fact = small_src.orders.unionByName(spark.createDataFrame(more, SCHEMA))
    before, left, remove = shuffle_files(spark), [], layout._remove

    def removed(spark, path):
        remove(spark, path)
        left.append(sorted(os.listdir(f"{folder}/{to.bucketed}_staged")) if "=" in path else [])

    monkeypatch.setattr(layout, "_remove", removed)
    try:
        layout.write_layout(fact, to, folder, buckets=4, heavy_share=0.03, round_lines=1)
        for _ in range(40):  # they go in the background
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.5)
        assert shuffle_files(spark) <= before
        assert [sum("=" in x for x in names) for names in left] == [7, 6, 5, 4, 3, 2, 1, 0, 0]
        assert not os.path.exists(f"{folder}/{to.bucketed}_staged")
        assert spark.conf.get(layout.SHUFFLES_GO) == "false"
        both = spark.table(to.bucketed).unionByName(spark.table(to.heavy)).select(*fact.columns)
        assert rows(both) == rows(fact)
        assert {None, "big"} <= {r[0] for r in spark.table(to.heavy).select("crm_member_id").distinct().collect()}
        file = F.input_file_name()
        files = spark.table(to.bucketed).select("month", F.regexp_extract(file, r"_(\d{5})\.", 1).alias("b"), file.alias("f")).distinct()
        assert files.count() == files.select("month", "b").distinct().count() and files.select("b").distinct().count() == 8
        want = O.member_order_single_pass(fact, P)
        assert rows(layout.metrics(spark, to, P).select(*want.columns)) == rows(want)
    finally:
        for t in (to.bucketed, to.heavy):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_round_shuffles_its_own_orders_only(spark, small_src, plain_joins):
    plan = small_src.orders.filter(layout.round_of_order() == 3)._jdf.queryExecution().executedPlan().toString()
    for key in ("l_orderkey", "o_orderkey"):
        scan = plan.index(f"FileScan parquet [{key}")
        assert "xxhash64" in plan[plan.rindex("Exchange", 0, scan):scan]
    orders = small_src.orders
    assert sum(orders.filter(layout.round_of_order() == k).count() for k in range(layout.ROUNDS)) == orders.count()


# ---- rejects

def test_malformed_ids_are_listed_and_counted_in_one_pass(spark):
    df = spark.createDataFrame([("1", 1), (" 007 ", 2), (None, 3), ("x1", 4), ("99999999999", 5), ("", 6), ("1.5", 7), ("-3", 8)], "id string, reason int")
    out = rejects.screen(df, "members", "id", tempfile.mkdtemp(prefix="loyalflow-rejects-"), most=0.6)
    assert (out.n_rows, out.n_rejects) == (8, 4)
    assert rows(out.rejects) == [("members", "", "not a whole number"), ("members", "1.5", "not a whole number"), ("members", "99999999999", "out of range"), ("members", "x1", "not a whole number")]
    assert rows(out.rows, "reason") == [(1,), (2,), (3,), (8,)] and out.rows.columns == ["id", "reason"]
    with pytest.raises(rejects.TooManyRejects, match="4 of 8"):
        rejects.screen(df, "members", "id", tempfile.mkdtemp(prefix="loyalflow-rejects-"))
    empty = rejects.screen(df.limit(0), "members", "id", tempfile.mkdtemp(prefix="loyalflow-rejects-"))
    assert (empty.n_rows, empty.n_rejects, empty.rows.count()) == (0, 0, 0)


def test_jobs_run_on_screened_inputs(spark, small_src):
    bad = small_src.not_belong_total.union(spark.createDataFrame([("x1",), ("99999999999",)], "member_detail_id string"))
    out = rejects.screen(bad, "not_belong_total", "member_detail_id", tempfile.mkdtemp(prefix="loyalflow-rejects-"), most=0.5)
    src = replace(small_src, not_belong_total=out.rows)
    assert rows(out.rejects, "id") == [("99999999999",), ("x1",)]
    assert historical_base_flags(src, P, cutoff_group(src, P)).count() == historical_base_flags(small_src, P, cutoff_group(small_src, P)).count()


# ---- snapshots

def test_the_latest_snapshot_not_after_the_run_date(spark):
    root = tempfile.mkdtemp(prefix="loyalflow-snapshots-")
    d = dt.date
    for day, mark in ((d(2024, 3, 1), 1), (d(2024, 3, 4), 2)):
        rel = spark.createDataFrame([("CHN A", str(mark), 1)], "distributor_name string, member_id string, is_wecom_member int")
        snapshots.write_snapshot(rel, root, "wecom_a", day)
        snapshots.write_snapshot(rel.select("distributor_name"), root, "list_info", day)
    want = ["distributor_name", "member_id", "is_wecom_member"]
    for run, mark in ((d(2024, 3, 3), "1"), (d(2024, 3, 4), "2"), (d(2025, 1, 1), "2")):
        got = snapshots.latest_snapshot(spark, root, "wecom_a", run, want)
        assert rows(got, "member_id") == [(mark,)]
        assert all(f"snapshot_dt=2024-03-0{1 if mark == '1' else 4}/" in f for f in got.inputFiles())
    with pytest.raises(snapshots.SnapshotError, match="no snapshot on or before 2024-02-01"):
        snapshots.latest_snapshot(spark, root, "wecom_a", d(2024, 2, 1))
    with pytest.raises(snapshots.SnapshotError, match="no snapshot"):
        snapshots.latest_snapshot(spark, root, "no_such_table", d(2024, 2, 1))
    swapped = spark.createDataFrame([("9", "CHN A", 1)], "member_id string, distributor_name string, is_wecom_member int")
    snapshots.write_snapshot(swapped, root, "wecom_a", d(2024, 3, 9))
    with pytest.raises(snapshots.SnapshotError, match="has the columns"):
        snapshots.latest_snapshot(spark, root, "wecom_a", d(2024, 3, 10), want)


# ---- a deployment's own names

def test_jobs_run_on_a_deployments_names(spark, small_src):
    root = tempfile.mkdtemp(prefix="loyalflow-deployment-")
    day = dt.date(2024, 3, 5)
    own = {**{n: getattr(small_src, n) for n in catalog.REQUIRED}, **small_src.lists}
    renamed = {"orders": {"buyer": "crm_member_id", "brand_channel": "distributor_name"}, "list_d": {"mobile_no": "phone"}}
    tables = {}
    for name, df in own.items():
        if name != "not_belong_total":
            tables[name] = f"dw_{name}"
            df.withColumnsRenamed({here: there for there, here in renamed.get(name, {}).items()}).createOrReplaceTempView(f"dw_{name}")
    snapshots.write_snapshot(small_src.not_belong_total, root, "total_2024", dt.date(2024, 2, 1))
    wecom = {}
    for k, snap in enumerate(small_src.wecom_snapshots):
        snapshots.write_snapshot(snap, root, f"wecom_{k}", dt.date(2024, 3, 1))
        wecom[f"wecom_{k}"] = tuple(snap.columns)
    where = catalog.Deployment(tables, renamed, root, {"not_belong_total": "total_2024"}, wecom)
    src = catalog.catalog_sources(spark, where, P, day)
    assert rows(historical_base_flags(src, P, cutoff_group(src, P))) == rows(historical_base_flags(small_src, P, cutoff_group(small_src, P)))
    with pytest.raises(catalog.MissingInputs, match=r"orders\.crm_member_id, orders\.distributor_name, .*store \(dw_nowhere\)"):
        catalog.catalog_sources(spark, replace(where, columns={"list_d": renamed["list_d"]}, tables={**tables, "store": "dw_nowhere"}), P, day)
