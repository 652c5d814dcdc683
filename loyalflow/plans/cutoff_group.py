"""Cutoff group (B16 -> K1): joined before the cutoff, did not belong, no wecom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.functions import int_id
from loyalflow.operators.membership import cutoff_belong
from loyalflow.operators.wecom import wecom_snapshot_union
from loyalflow.sources import Sources


def cutoff_group(src: Sources, program: Program) -> DataFrame:
    """(distributor_name, member_detail_id) rows; a bag, duplicates kept.

    list phone = member phone (inner), member joined before the cutoff (semi join on
    the string id, as written), then two anti joins on (int id, label): not belonging
    and not connected.  ``left_anti`` keeps rows whose label is NULL, as the
    LEFT JOIN ... IS NULL form does.
    """
    strict = program.strict_id_cast
    phones = src.member_phone.filter(F.col("phone_source_type") == program.phone_source_type).select(
        F.col("member_detail_id").cast("string").alias("member_detail_id"),
        F.col("phone").cast("string").alias("_mp_phone"),
    )
    base = src.list_info.select(F.col("phone").cast("string").alias("_phone"), "distributor_name")
    matched = base.join(phones, base["_phone"] == phones["_mp_phone"], "inner").select(
        "distributor_name", "member_detail_id")

    joined = src.member_detail.filter(F.to_date("join_time") < F.lit(program.cutoff_date)).select(
        "member_detail_id")
    matched = matched.join(joined, "member_detail_id", "left_semi")
    matched = matched.withColumn("_mid", int_id("member_detail_id", strict))

    belong = cutoff_belong(src.member_detail, src.orders, program).select(
        int_id("member_detail_id", strict).alias("_mid"), "distributor_name")
    wecom = wecom_snapshot_union(src.wecom_snapshots).select(
        int_id("member_id", strict).alias("_mid"), "distributor_name")

    out = matched.join(belong, ["_mid", "distributor_name"], "left_anti")
    out = out.join(wecom, ["_mid", "distributor_name"], "left_anti")
    return out.select("distributor_name", "member_detail_id")
