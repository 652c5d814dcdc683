"""Column functions: comma stripping, id cast and padding, roll-ups, batch stamp."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.functions import batch_date, int_id, pad_id, rollup_partner, strip_commas, tier_flag, tier_number


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_strip_commas(spark):
    assert one(spark, strip_commas("v"), "130,0000,1234") == "13000001234"
    assert one(spark, strip_commas("v"), None) is None


def test_pad_id_keeps_last_digits(spark):
    assert one(spark, pad_id("v"), "12") == "000000012"
    assert one(spark, pad_id("v"), "000000012") == "000000012"
    # right(), not lpad(): a 10-digit id keeps its last 9 digits
    assert one(spark, pad_id("v"), "1234567890") == "234567890"


def test_int_id_strict_and_try(spark):
    assert one(spark, int_id("v"), "0012") == 12
    assert one(spark, int_id("v", strict=False), "abc") is None
    with pytest.raises(Exception):
        one(spark, int_id("v", strict=True), "abc")


def test_batch_date_is_days_not_minutes(spark):
    ts = dt.datetime(2024, 3, 5, 10, 7, 0)
    assert one(spark, batch_date(F.col("v")), ts, "v timestamp_ntz") == "20240305"


def test_tier_number_and_flag(spark):
    ranks = ("T1", "T2", "T3")
    assert one(spark, tier_number("v", ranks), "T2") == 2
    assert one(spark, tier_number("v", ranks), "T?") is None
    assert one(spark, tier_flag("v", ("T2",)), None) == "0"
    assert one(spark, tier_flag("v", ("T2",)), "T2") == "1"


def test_old_name_folds_only_in_cutoff_job(spark):
    """The old B name rolls into B on the cutoff path but stays itself in the daily job."""
    assert one(spark, rollup_partner("v", P.rollup_cutoff_reg), "CHN B OLD") == "CHN B (B1) and CHN B (B2)"
    assert one(spark, rollup_partner("v", P.rollup_cutoff_order), "CHN B OLD") == "CHN B (B1) and CHN B (B2)"
    assert one(spark, rollup_partner("v", P.rollup_daily_order), "CHN B OLD") == "CHN B OLD"
    assert one(spark, rollup_partner("v", P.rollup_daily_reg), "CHN B OLD") == "CHN B OLD"


def test_case_handling_differs_per_rollup(spark):
    # upper-cased test, raw fallback (cutoff) vs upper-cased fallback (daily registration)
    assert one(spark, rollup_partner("v", P.rollup_cutoff_reg), "chn d (d1)") == "chn d (d1)"
    assert one(spark, rollup_partner("v", P.rollup_daily_reg), "chn d (d1)") == "CHN D (D1)"
    assert one(spark, rollup_partner("v", P.rollup_cutoff_reg), "chn a (a1)") == "CHN A (A1) and CHN A (A2)"
    # daily order roll-up is case-sensitive
    assert one(spark, rollup_partner("v", P.rollup_daily_order), "chn a (a1)") == "chn a (a1)"
    assert one(spark, rollup_partner("v", P.rollup_daily_order), "CHN A (A2)") == "CHN A"


def test_relabel(spark):
    assert one(spark, rollup_partner("v", P.rollup_relabel), "CHN C (C1) and CHN C (C2)") == "CHN C (C1) & CHN C (C2)"
    assert one(spark, rollup_partner("v", P.rollup_relabel), "CHN D (D1)") == "CHN D (D1)"
