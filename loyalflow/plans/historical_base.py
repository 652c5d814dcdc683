"""Historical member base (B17 -> K2): unified lists + encrypted phone + two flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.functions import flag, int_id, rollup_partner
from loyalflow.operators.identity import phone_members
from loyalflow.operators.joins import left_join_spread
from loyalflow.operators.lists import BASE_COLUMNS, historical_base
from loyalflow.sources import Sources

K2_COLUMNS = [
    "phone", "encrypt_phone", "partner", "distributor", "historical_join_dt",
    "historical_join_channel", "historical_vip_tier", "historical_city",
    "if_historical_high_vip_tier", "if_not_belong_nor_wecom_by_partner",
    "if_not_belong_nor_wecom_total",
]


def historical_base_flags(src: Sources, program: Program, group_two: DataFrame,
                          base: DataFrame | None = None) -> DataFrame:
    """K2 rows: DISTINCT over the 11 output columns.

    Each list row is resolved to its members (LEFT, fans out), and two flags say
    whether that member is in the cutoff group for this partner / in the total group.
    The member id is not output, so the final DISTINCT folds the fan-out back; a phone
    whose members disagree on a flag keeps one row per flag combination.

    Rows without an encrypted phone or member cannot match; their NULL keys are spread
    over the shuffle instead of landing in one partition, and so are heavy phones and members with ``Program.hot_key_share``.
    """
    strict, hot = program.strict_id_cast, program.hot_key_share
    if base is None:
        base = historical_base(src.lists, program)
    spread = ["phone", "partner"]
    enc = src.encrypt_phone.select(F.col("phone"), "encrypt_phone")
    base = base.distinct()  # as the result is; folds the rows without a phone that are alike
    with_enc = left_join_spread(base, enc, ["phone"], [c for c in base.columns if c != "phone"], hot)

    by_partner = group_two.select(
        int_id("member_detail_id", strict).alias("_mid"),
        rollup_partner("distributor_name", program.rollup_relabel).alias("partner"),
    ).distinct().withColumn("_g2", F.lit(True))
    total = src.not_belong_total.select(int_id("member_detail_id", strict).alias("_mid")).distinct() \
        .withColumn("_ttl", F.lit(True))

    members = phone_members(src.crm_member_phone)
    resolved = left_join_spread(with_enc, members, ["encrypt_phone"], spread, hot) \
        .withColumn("_mid", int_id("phone_member_id", strict))
    flagged = left_join_spread(resolved, by_partner, ["_mid", "partner"], spread, hot)
    flagged = left_join_spread(flagged, total, ["_mid"], spread, hot)
    return flagged.select(
        *BASE_COLUMNS, "encrypt_phone",
        flag(F.col("_g2").isNotNull()).alias("if_not_belong_nor_wecom_by_partner"),
        flag(F.col("_ttl").isNotNull()).alias("if_not_belong_nor_wecom_total"),
    ).select(*K2_COLUMNS).distinct()
