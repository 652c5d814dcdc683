"""Messaging-app ("wecom") connections between members and store clerks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.functions import rollup_partner
from loyalflow.operators.joins import left_join_spread_nulls


def wecom_pairs(src, program: Program, keep_unbound: bool = True) -> DataFrame:
    """DISTINCT (member id, partner) over live clerk-shopper relations.

    relation JOIN staff (own-store channel, staff with a store) LEFT JOIN bind (union id
    of the configured app).  The right-only bind conditions are applied to the bind side
    before the join, as the ON clause means.  Relations whose shopper has no bound
    member give a NULL member; ``keep_unbound=False`` drops them where only matchable
    members matter.
    """
    staff = src.staff.filter(
        F.col("store_code").isNotNull() & (F.col("channel") == program.staff_channel)
    ).select("staff_ext_id", rollup_partner("distributor", program.rollup_daily_order).alias("partner_customized"))
    rel = src.relation.filter(F.col("relation_deleted") == 0).select(
        "staff_ext_id", "external_user_unionid", "relation_created_at")
    bind = src.bind.filter(
        (F.col("id_type") == program.bind_id_type) & (F.col("thirdparty_app_id") == program.bind_app_id)
    ).select(F.col("id_value").alias("external_user_unionid"), "member_detail_id")
    linked = rel.join(staff, "staff_ext_id", "inner")
    if keep_unbound:
        # relations without a union id keep a NULL key; spread them instead of one partition
        pairs = left_join_spread_nulls(linked, bind, ["external_user_unionid"], ["staff_ext_id", "relation_created_at"])
    else:
        pairs = linked.join(bind, "external_user_unionid", "inner")
    return pairs.select("member_detail_id", "partner_customized").distinct()


def wecom_snapshot_union(snapshots: list[DataFrame]) -> DataFrame:
    """UNION ALL of the dated snapshots, connected members only.

    Snapshots name the member column differently; the union is positional over
    (distributor_name, member id, is_wecom_member), so columns are picked by position.
    """
    parts = []
    for snap in snapshots:
        dist, member, is_member = snap.columns  # exactly three
        parts.append(snap.filter(F.col(is_member) == 1).select(
            F.col(dist).alias("distributor_name"),
            F.col(member).alias("member_id"),
            F.col(is_member).alias("is_wecom_member"),
        ))
    return reduce(DataFrame.unionByName, parts)
