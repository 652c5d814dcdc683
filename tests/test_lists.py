"""Partner-list builder on hand-made frames: tier picks, NULL order, side lists."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.operators.lists import build_list, historical_base
from tests.conftest import rows

D = dt.date


def test_lowest_tier_wins_and_unranked_loses(spark):
    spec = P.list_spec("list_e")
    src = spark.createDataFrame([
        ("130,0000,0001", D(2020, 1, 1), "T3", "x"),
        ("13000000001", D(2021, 1, 1), "T2", "y"),
        ("13000000001", D(2022, 1, 1), "T?", "z"),
    ], "phone_number string, historical_join_dt date, historical_vip_tier string, city string")
    out = build_list(spec, {"list_e": src}, P)
    assert rows(out, "phone", "historical_vip_tier", "if_historical_high_vip_tier") == [("13000000001", "T2", "1")]


def test_tier_pick_highest_is_an_option(spark):
    spec = P.list_spec("list_e")
    src = spark.createDataFrame([
        ("1", D(2020, 1, 1), "T3", "x"), ("1", D(2021, 1, 1), "T2", "y"),
    ], "phone_number string, historical_join_dt date, historical_vip_tier string, city string")
    out = build_list(spec, {"list_e": src}, replace(P, tier_pick="highest"))
    assert rows(out, "historical_vip_tier") == [("T3",)]


def test_null_join_date_wins(spark):
    spec = P.list_spec("list_f")
    src = spark.createDataFrame([("1", D(2020, 1, 1)), ("1", None), ("2", D(2020, 1, 1)), ("2", D(2021, 1, 1))],
                                "phone string, historical_join_dt date")
    out = build_list(spec, {"list_f": src}, P)
    assert rows(out, "phone", "historical_join_dt") == [("1", None), ("2", "2021-01-01")]


def test_default_tier_uses_raw_match_for_number_and_flag(spark):
    spec = P.list_spec("list_g")
    base = spark.createDataFrame([("1,2",), ("3",)], "phone string")
    high = spark.createDataFrame([("12", "T3"), ("12", "T2"), ("12", "T5")], "phone string, historical_vip_tier string")
    out = build_list(spec, {"list_g": base, "list_g_high": high}, P)
    # matched phone keeps its lowest ranked side tier; unmatched phone gets the default
    # tier text but flag '0' (the flag reads the raw, missing side tier)
    assert rows(out, "phone", "historical_vip_tier", "if_historical_high_vip_tier") == [
        ("12", "T2", "1"), ("3", "T1", "0")]


def test_flag_from_side_match_fans_out_per_distributor(spark):
    spec = P.list_spec("list_c")
    base = spark.createDataFrame([("1", None, "C1", "T1", "X"), ("2", None, "C1", "T1", "X")],
                                 "phone string, historical_join_dt date, historical_join_channel string, "
                                 "historical_vip_tier string, historical_city string")
    high = spark.createDataFrame([("1", "CHN C (C1)"), ("1", "CHN C (C2)"), ("2", "OTHER")],
                                 "phone string, distributor_name string")
    out = build_list(spec, {"list_c": base, "high_tier": high}, P)
    assert rows(out, "phone", "distributor", "if_historical_high_vip_tier") == [
        ("1", "CHN C (C1)", "1"), ("1", "CHN C (C2)", "1"), ("2", None, "0")]


def test_list_without_dedupe_keeps_duplicates(spark):
    spec = P.list_spec("list_j")
    src = spark.createDataFrame([("1", None, "C"), ("1", None, "C")],
                                "phone string, historical_join_dt date, historical_join_channel string")
    assert build_list(spec, {"list_j": src}, P).count() == 2


def test_base_invariants_on_fixture(small_src):
    base = historical_base(small_src.lists, P)
    assert base.filter("phone LIKE '%,%'").count() == 0
    ranked = [s.partner for s in P.lists if s.tier_rank or s.rank_by_join_dt]
    dup = base.filter(base.partner.isin(ranked)).groupBy("partner", "phone").count().filter("count > 1")
    assert dup.count() == 0


def test_grouped_dedupe_equals_per_list_dedupe(small_src):
    """The base dedupes on the union (2 shuffles); it must equal deduping each list alone."""
    from functools import reduce

    from pyspark.sql import DataFrame

    per_list = reduce(DataFrame.unionByName, [build_list(s, small_src.lists, P) for s in P.lists])
    assert rows(historical_base(small_src.lists, P)) == rows(per_list)
