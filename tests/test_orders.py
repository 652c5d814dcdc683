"""Order metrics: net sales, presence semantics, last-order ranking and its fan-out."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.operators import orders as O
from tests.conftest import rows

SCHEMA = ("crm_member_id string, distributor_name string, original_order_id string, order_paid_time timestamp_ntz, "
          "date_id date, original_store_code string, sku_id string, sku_name string, sales_qty decimal(18,2), "
          "order_rrp_amt decimal(18,2), is_member string, is_rrp_sales_type int, if_eff_order_tag boolean")
T = dt.datetime
D = dt.date


def line(member, dist, order, paid, qty, amt, is_member="Y", rrp=1, eff=True, store="S1", sku="k1", name="n1"):
    return (member, dist, order, paid, D(2020, 1, 1), store, sku, name,
            Decimal(qty) if qty is not None else None, Decimal(amt), is_member, rrp, eff)


def test_net_sales_counts_member_lines_only(spark):
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", T(2020, 1, 1), "2", "10.00"),
        line("1", "CHN D (D1)", "o1", T(2020, 1, 1), "-1", "-4.00"),
        line("1", "CHN D (D1)", "o2", T(2020, 1, 1), "0", "99.00"),
        line("1", "CHN D (D1)", "o3", T(2020, 1, 1), None, "99.00"),
        line("1", "CHN D (D1)", "o4", T(2020, 1, 1), "1", "50.00", is_member="N"),
        line("1", "CHN D (D1)", "o5", T(2020, 1, 1), "1", "70.00", rrp=0),
    ], SCHEMA)
    assert rows(O.net_sales_total(df, P), "crm_member_id", "mbr_sales") == [("1", Decimal("6.00"))]


def test_order_count_exists_only_with_an_effective_line(spark):
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", T(2020, 1, 1), "1", "10.00", eff=None),
        line("2", "CHN D (D1)", "o2", T(2020, 1, 1), "1", "10.00", eff=True),
    ], SCHEMA)
    single = O.member_order_single_pass(df, P).filter("level = 'member'")
    assert rows(single, "crm_member_id", "has_eff", "order_count") == [("1", False, None), ("2", True, 1)]
    assert rows(O.orders_total(df), "crm_member_id") == [("2",)]


def test_single_pass_equals_separate_group_bys(small_src):
    o = small_src.orders
    single = O.member_order_single_pass(o, P)
    part = single.filter("level = 'partner'")
    mem = single.filter("level = 'member'")
    assert rows(part.filter("has_eff"), "partner", "crm_member_id", "order_count") == \
        rows(O.orders_by_partner(o, P), "partner", "crm_member_id", "order_count")
    assert rows(part, "partner", "crm_member_id", "mbr_sales") == \
        rows(O.net_sales_by_partner(o, P), "partner", "crm_member_id", "mbr_sales")
    assert rows(mem.filter("has_eff"), "crm_member_id", "order_count") == \
        rows(O.orders_total(o), "crm_member_id", "order_count")
    assert rows(mem, "crm_member_id", "mbr_sales") == rows(O.net_sales_total(o, P), "crm_member_id", "mbr_sales")


def test_distinct_orders_are_not_additive_over_partners(spark):
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", T(2020, 1, 1), "1", "1.00"),
        line("1", "CHN E (E1)", "o1", T(2020, 1, 1), "1", "1.00"),
    ], SCHEMA)
    single = O.member_order_single_pass(df, P)
    assert rows(single.filter("level = 'member'"), "order_count") == [(1,)]
    assert rows(single.filter("level = 'partner'"), "order_count") == [(1,), (1,)]


def test_null_paid_time_wins_the_last_order(spark):
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "1.00"),
        line("1", "CHN D (D1)", "o2", None, "1", "1.00"),
        line("2", "CHN D (D1)", "o3", T(2021, 1, 1), "1", "1.00"),
        line("2", "CHN D (D1)", "o4", T(2021, 1, 1), "1", "1.00"),
    ], SCHEMA)
    out = O.last_order_ranked(df, P)
    # NULL paid time sorts as the largest value; equal paid times fall back to order id
    assert rows(out, "crm_member_id", "original_order_id") == [("1", "o2"), ("2", "o4")]


def test_last_order_join_without_member_key_fans_out(spark):
    """Pinned on purpose: the last-order join has no member key, as written."""
    df = spark.createDataFrame([
        # order o1 is the last order of members 1 and 2 of the same partner
        line("1", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "10.00", sku="a"),
        line("2", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "5.00", sku="b"),
        # order o2 holds members 3 and 4; it is the last order only for member 3
        line("3", "CHN D (D1)", "o2", T(2021, 6, 1), "1", "7.00"),
        line("4", "CHN D (D1)", "o2", T(2021, 6, 1), "1", "3.00"),
        line("4", "CHN D (D1)", "o9", T(2022, 1, 1), "1", "1.00"),
    ], SCHEMA)
    store = spark.createDataFrame([("S1", "Store one")], "store_code string, store_name string")
    out = O.last_order_details(df, store, P)
    got = rows(out, "crm_member_id", "original_order_id", "mbr_sales", "sku_id", "store_name")
    assert got == [
        ("1", "o1", Decimal("20.00"), "a", "Store one"),   # matched twice -> doubled
        ("2", "o1", Decimal("10.00"), "b", "Store one"),
        ("3", "o2", Decimal("7.00"), "k1", "Store one"),
        ("4", "o2", Decimal("3.00"), "k1", "Store one"),   # extra row for member 4 via member 3's order
        ("4", "o9", Decimal("1.00"), "k1", "Store one"),
    ]


def test_listagg_is_sorted_distinct(spark):
    df = spark.createDataFrame([
        line("1", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "1.00", sku="b", name=None),
        line("1", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "1.00", sku="a", name=None),
        line("1", "CHN D (D1)", "o1", T(2021, 1, 1), "1", "1.00", sku="b", name=None),
    ], SCHEMA)
    store = spark.createDataFrame([], "store_code string, store_name string")
    out = O.last_order_details(df, store, P).select("sku_id", "sku_name", "store_name", "mbr_sales")
    assert rows(out) == [("a, b", None, None, Decimal("3.00"))]


def test_eff_tag_null_is_false(spark):
    df = spark.createDataFrame([(None,), (True,), (False,)], "if_eff_order_tag boolean")
    assert [r[0] for r in df.select(O.eff_line()).collect()] == [False, True, False]
    assert df.filter(F.col("if_eff_order_tag").isNull()).count() == 1
