"""Partner lists -> one unified historical base.

One generic builder turns a ``ListSpec`` into the common 8-column shape; the partner's
quirks (tier ranks, high tiers, side lists, dedupe policy) are data in the spec.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalflow.config import ListSpec, Program
from loyalflow.functions import strip_commas, tier_flag, tier_number
from loyalflow.operators.joins import left_join_spread_nulls

BASE_COLUMNS = [
    "phone",
    "partner",
    "distributor",
    "historical_join_dt",
    "historical_join_channel",
    "historical_vip_tier",
    "historical_city",
    "if_historical_high_vip_tier",
]



def _null() -> "F.Column":
    return F.lit(None).cast("string")


def _by_phone(src: DataFrame, side: DataFrame, spec: ListSpec) -> DataFrame:
    """LEFT JOIN on the stripped phone.  The lists with a side list come out DISTINCT, so equal rows
    fold first; what is left of the NULL phones is spread over the other columns."""
    src = src.distinct().withColumn("_phone", strip_commas(spec.phone))
    spread = [c for c in src.columns if c != "_phone"]
    return left_join_spread_nulls(src, side, ["_phone"], spread)


def _side_tier(src: DataFrame, side: DataFrame, spec: ListSpec) -> DataFrame:
    """Attach the side list's tier by comma-stripped phone (LEFT, may fan out)."""
    side = side.select(strip_commas("phone").alias("_phone"), F.col(spec.side_tier).alias("_side_tier"))
    return _by_phone(src, side, spec)


def _side_match(src: DataFrame, side: DataFrame, spec: ListSpec) -> DataFrame:
    """Attach the side list's distributor and a matched marker (LEFT, may fan out)."""
    side = side.filter(F.col(spec.side_distributor).isin(list(spec.side_filter))).select(
        strip_commas("phone").alias("_phone"),
        F.col(spec.side_distributor).alias("_side_distributor"),
        F.col("phone").isNotNull().alias("_side_hit"),
    )
    return _by_phone(src, side, spec)


def _shape(spec: ListSpec, lists: Mapping[str, DataFrame], program: Program) -> DataFrame:
    """One partner list in the unified 8-column shape plus ``_tier_number``, not yet deduplicated."""
    src = lists[spec.key]
    distributor = _null()
    tier_num = None
    if spec.side_tier:
        src = _side_tier(src, lists[spec.side], spec)
        raw_tier = F.col("_side_tier")
        tier = F.when(raw_tier.isNotNull(), raw_tier).otherwise(F.lit(spec.default_tier))
        flag = tier_flag("_side_tier", spec.high_tiers)
        if spec.tier_rank:
            tier_num = tier_number("_side_tier", spec.tier_rank)
    else:
        tier = F.col(spec.tier) if spec.tier else _null()
        if spec.flag == "side_match":
            src = _side_match(src, lists[spec.side], spec)
            distributor = F.col("_side_distributor")
            flag = F.when(F.col("_side_hit").isNotNull(), F.lit("1")).otherwise(F.lit("0"))
        elif spec.flag == "tier":
            flag = tier_flag(spec.tier, spec.high_tiers) if spec.tier else F.lit("0")
        else:
            flag = _null()
        if spec.tier_rank and spec.tier:
            tier_num = tier_number(spec.tier, spec.tier_rank)

    out = src.select(
        strip_commas(spec.phone).alias("phone"),
        F.lit(spec.partner).alias("partner"),
        distributor.cast("string").alias("distributor"),
        (F.to_date(spec.join_dt).cast("string") if spec.join_dt else _null()).alias("historical_join_dt"),
        (F.col(spec.channel) if spec.channel else _null()).alias("historical_join_channel"),
        tier.cast("string").alias("historical_vip_tier"),
        (F.col(spec.city) if spec.city else _null()).alias("historical_city"),
        flag.cast("string").alias("if_historical_high_vip_tier"),
        (tier_num if tier_num is not None else F.lit(None).cast("int")).alias("_tier_number"),
    )

    return out


def _ranked(spec: ListSpec) -> bool:
    return bool(spec.tier_rank or spec.rank_by_join_dt)


def build_list(spec: ListSpec, lists: Mapping[str, DataFrame], program: Program) -> DataFrame:
    """One partner list in the unified 8-column shape, deduplicated per its spec."""
    out = _shape(spec, lists, program)
    if _ranked(spec):
        out = best_per_phone(out, by_tier=bool(spec.tier_rank), tier_pick=program.tier_pick)
    elif spec.distinct:
        out = out.select(*BASE_COLUMNS).distinct()
    return out.select(*BASE_COLUMNS)


def best_per_phone(df: DataFrame, by_tier: bool, tier_pick: str = "lowest") -> DataFrame:
    """Keep one row per phone: ranked tier first, then the latest join date.

    One row per (partner, phone).  NULL order follows the warehouse the lists were
    written for (NULL sorts as the largest value): an unranked tier loses, a missing
    join date wins.  The remaining
    columns break ties so the pick is deterministic.  ``row_number() = 1`` plans as a
    map-side partial ``WindowGroupLimit``, so a phone repeated millions of times is cut
    down before the shuffle.
    """
    order = []
    if by_tier:
        t = F.col("_tier_number")
        order.append(t.asc_nulls_last() if tier_pick == "lowest" else t.desc_nulls_last())
    order.append(F.col("historical_join_dt").desc_nulls_first())
    order += [F.col(c).desc_nulls_last() for c in
              ("historical_vip_tier", "historical_city", "historical_join_channel",
               "distributor", "if_historical_high_vip_tier")]
    w = Window.partitionBy("partner", "phone").orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def historical_base(lists: Mapping[str, DataFrame], program: Program) -> DataFrame:
    """UNION ALL of every partner list in the program.

    Each list carries its own constant partner label, so the per-list dedupes can run
    on the union: one DISTINCT for every DISTINCT list, and one top-1 window partitioned
    by (partner, phone) for every ranked list (a list ranked by join date only has a
    NULL tier rank on every row, which leaves its order unchanged).  Two shuffles
    instead of one per list; the rows are the same.
    """
    shaped = [(spec, _shape(spec, lists, program)) for spec in program.lists]
    ranked = [df for spec, df in shaped if _ranked(spec)]
    distinct = [df.select(*BASE_COLUMNS) for spec, df in shaped if not _ranked(spec) and spec.distinct]
    plain = [df.select(*BASE_COLUMNS) for spec, df in shaped if not _ranked(spec) and not spec.distinct]
    parts = []
    if ranked:
        parts.append(best_per_phone(reduce(DataFrame.unionByName, ranked), by_tier=True,
                                    tier_pick=program.tier_pick).select(*BASE_COLUMNS))
    if distinct:
        parts.append(reduce(DataFrame.unionByName, distinct).distinct())
    return reduce(DataFrame.unionByName, parts + plain)
