"""End-to-end jobs on the sf0.001 fixture: spread join, invariants, sinks."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.config import RunContext
from loyalflow.operators.joins import left_join_spread_nulls
from loyalflow.operators.membership import cutoff_belong
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import K2_COLUMNS, historical_base_flags
from loyalflow.plans.migration import K3_COLUMNS, migration_performance
from loyalflow.plans.sinks import published, reload_table, replace_table
from tests.conftest import rows


def test_spread_join_equals_plain_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d"), (2, "e")], "k int, s string")
    right = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, v string")
    got = rows(left_join_spread_nulls(left, right, ["k"], ["s"]), "k", "s", "v")
    want = rows(left.join(right, ["k"], "left"), "k", "s", "v")
    assert got == want


def test_spread_join_several_right_sides(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, s string")
    r1 = spark.createDataFrame([(1, "x")], "k int, v string")
    r2 = spark.createDataFrame([(1, "p"), (1, "q")], "k int, w string")
    got = rows(left_join_spread_nulls(left, [r1, r2], ["k"], ["s"]), "k", "s", "v", "w")
    assert got == [(None, "b", None, None), (1, "a", "x", "p"), (1, "a", "x", "q")]


def _jobs(spark, src):
    k1 = cutoff_group(src, P)
    k2 = historical_base_flags(src, P, k1)
    k3 = migration_performance(src, P, k2, RunContext())
    return k1, k2, k3


def test_cutoff_group_excludes_belong_and_wecom(spark, small_src):
    k1, _, _ = _jobs(spark, small_src)
    k1i = k1.select(F.col("member_detail_id").cast("int").alias("m"), "distributor_name")
    belong = cutoff_belong(small_src.member_detail, small_src.orders, P).select(
        F.col("member_detail_id").cast("int").alias("m"), "distributor_name")
    assert k1i.join(belong, ["m", "distributor_name"], "inner").count() == 0
    assert k1.count() > 0


def test_historical_base_has_no_duplicates(spark, small_src):
    _, k2, _ = _jobs(spark, small_src)
    assert k2.columns == K2_COLUMNS
    assert k2.count() == k2.distinct().count()


def test_wide_table_invariants(spark, small_src):
    _, k2, k3 = _jobs(spark, small_src)
    k3 = k3.cache()
    assert k3.columns == K3_COLUMNS
    # every base row survives (all joins LEFT)
    assert k2.select("phone", "partner").distinct().subtract(k3.select("phone", "partner").distinct()).count() == 0
    assert k3.filter("if_partner_member_base = 1 AND if_chn_member_base = 0").count() == 0
    assert k3.filter("belong_to_chn_dt > belong_to_partner_dt").count() == 0
    assert k3.filter("if_partner_member_base = 0 AND (ever_purchased_in_chn = 1 OR ever_purchased_in_partner = 1 "
                     "OR ttl_rrp_sales_in_chn IS NOT NULL OR last_purchase_in_partner_dt IS NOT NULL "
                     "OR add_partner_wecom = 1)").count() == 0
    assert k3.filter("ever_purchased_in_partner = 1 AND ever_purchased_in_chn = 0").count() == 0
    assert k3.filter("ttl_orders_in_partner > ttl_orders_in_chn").count() == 0
    assert k3.filter("member_detail_id IS NOT NULL AND length(member_detail_id) <> 9").count() == 0
    assert k3.filter("if_partner_member_base = 1").count() > 0
    assert rows(k3.select("dl_batch_date").distinct()) == [("20240305",)]
    k3.unpersist()


def test_sinks_round_trip(spark, small_src):
    k1, k2, k3 = _jobs(spark, small_src)
    folder = tempfile.mkdtemp(prefix="loyalflow-sink-")
    replace_table(k1, f"{folder}/k1")
    replace_table(k2, f"{folder}/k2")
    reload_table(k3.select(*reversed(K3_COLUMNS)), f"{folder}/k3")
    back = spark.read.parquet(f"{folder}/k3")
    assert back.columns == K3_COLUMNS
    assert back.count() == k3.count()
    assert spark.read.parquet(f"{folder}/k1").count() == k1.count()


def test_three_jobs_through_tables(spark, small_src):
    """K3's table exists: its columns stay, and a second run replaces the first."""
    from datetime import datetime

    from loyalflow.plans.pipeline import Targets, run_pipeline

    _, _, k3 = _jobs(spark, small_src)
    for t in ("t_k1", "t_k2", "t_metrics", "t_k3"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    k3.limit(0).write.format("parquet").saveAsTable("t_k3")
    schema = spark.table("t_k3").schema
    to = Targets("t_k1", "t_k2", "t_metrics", "t_k3")
    for when in (datetime(2024, 3, 4, 1), datetime(2024, 3, 5, 1)):
        spark.catalog.refreshTable("t_k3")
        out = run_pipeline(spark, small_src, P, RunContext(run_ts=when), to)
        assert out.schema == schema and rows(out.select("dl_batch_date").distinct()) == [(when.strftime("%Y%m%d"),)]
        same = [c for c in K3_COLUMNS if not c.startswith("dl_")]
        want = migration_performance(small_src, P, spark.table("t_k2"), RunContext(run_ts=when))
        assert out.select(same).exceptAll(want.select(same)).count() == 0 and out.count() == want.count() > 0
    assert not spark.catalog.tableExists("t_metrics")
    for t in ("t_k1", "t_k2", "t_k3"):
        spark.sql(f"DROP TABLE {t}")


def test_published_names(spark, small_src):
    """A deployment's column names reach all three tables, and the next job still finds its columns."""
    from dataclasses import replace

    from loyalflow.plans.pipeline import Targets, run_pipeline

    names = {"group_two": {"distributor_name": "partner_group"}, "base": {"partner": "retailer", "encrypt_phone": "phone_key"},
             "performance": {"ttl_orders_in_chn": "ttl_orders_brand", "partner": "retailer"}}
    folder = tempfile.mkdtemp(prefix="loyalflow-names-")
    to = Targets(*(f"{folder}/{t}" for t in ("k1", "k2", "metrics", "k3")), as_tables=False)
    out = run_pipeline(spark, small_src, replace(P, names=names), RunContext(), to)
    assert out.columns == [names["performance"].get(c, c) for c in K3_COLUMNS]
    assert spark.read.parquet(f"{folder}/k1").columns == ["partner_group", "member_detail_id"]
    assert spark.read.parquet(f"{folder}/k2").columns == [names["base"].get(c, c) for c in K2_COLUMNS]
    _, _, k3 = _jobs(spark, small_src)
    assert out.exceptAll(k3.select(*K3_COLUMNS)).count() == 0 and out.count() == k3.count() > 0
    with pytest.raises(ValueError, match="nothing_of_that_name"):
        published(k3, {"nothing_of_that_name": "x"})


def test_queries_read_the_tables_as_they_are(spark):
    import glob
    import os
    import shutil

    from loyalflow.plans.queries import QUERIES

    folder = tempfile.mkdtemp(prefix="loyalflow-tables-")
    for f in glob.glob("/root/testdata/sf0.001/*.parquet"):
        shutil.copy(f, folder)
    before = QUERIES["padded_member_id"](spark, folder).count()
    half = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").where("c_custkey % 2 = 0").toPandas()
    os.chmod(f"{folder}/customer.parquet", 0o644)
    half.to_parquet(f"{folder}/customer.parquet")
    spark.catalog.clearCache()
    assert QUERIES["padded_member_id"](spark, folder).count() < before


def test_rows_without_a_phone_are_spread(spark):
    """Most phones NULL in a side-list join: same rows as the plain join, and no partition with the bulk."""
    from loyalflow.operators.joins import left_join_spread_nulls

    left = spark.range(0, 20_000).selectExpr("if(id % 10 = 0, cast(id as string), null) k", "id % 997 a", "id % 13 b")
    right = spark.range(0, 20_000, 30).selectExpr("cast(id as string) k", "id v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        got = left_join_spread_nulls(left, right, ["k"], ["a", "b"])
        assert rows(got.select("k", "a", "b", "v")) == rows(left.join(right, "k", "left").select("k", "a", "b", "v"))
        sizes = [r["n"] for r in got.selectExpr("spark_partition_id() p").groupBy("p").agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2 * sum(sizes) / 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_distributor_filter_limits_the_cutoff_order_branch(spark, small_src):
    from dataclasses import replace

    only = replace(P, distributors=("CHN D (D1)",))
    full = cutoff_belong(small_src.member_detail, small_src.orders, P)
    cut = cutoff_belong(small_src.member_detail, small_src.orders, only)
    assert 0 < cut.count() < full.count()
    # the registration branch is untouched by the filter
    assert cut.subtract(full).count() == 0


def test_non_numeric_member_id_fails_strict_and_is_unmatched_with_try(spark, small_src):
    import pytest
    from dataclasses import replace

    from loyalflow.sources import Sources

    bad = small_src.not_belong_total.union(spark.createDataFrame([("x1",)], "member_detail_id string"))
    src = Sources(**{**small_src.__dict__, "not_belong_total": bad})
    k1 = cutoff_group(src, P)
    with pytest.raises(Exception):
        historical_base_flags(src, P, k1).count()
    loose = replace(P, strict_id_cast=False)
    assert historical_base_flags(src, loose, cutoff_group(src, loose)).count() == \
        historical_base_flags(small_src, P, k1).count()


def test_spread_join_two_keys_with_partial_nulls(spark):
    left = spark.createDataFrame([(1, "a", "x"), (1, None, "y"), (None, "a", "z"), (2, "b", "w")],
                                 "k int, p string, s string")
    right = spark.createDataFrame([(1, "a", 10), (1, None, 11), (None, "a", 12), (2, "b", 13), (2, "b", 14)],
                                  "k int, p string, v int")
    got = rows(left_join_spread_nulls(left, right, ["k", "p"], ["s"]), "k", "p", "s", "v")
    want = rows(left.join(right, ["k", "p"], "left"), "k", "p", "s", "v")
    assert got == want
