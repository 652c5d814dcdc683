"""Who belongs to which partner."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.functions import rollup_partner
from loyalflow.operators.orders import eff_line, rrp_lines


def cutoff_belong(member_detail: DataFrame, orders: DataFrame, program: Program) -> DataFrame:
    """(member, combined partner) pairs that belonged before the cutoff.

    Registered in an own-store channel (case-insensitive test), or bought as a member
    with an effective RRP order line, before ``cutoff_date``.  UNION (distinct).
    """
    cutoff = F.lit(program.cutoff_date)
    reg = member_detail.filter(
        F.upper("eff_reg_channel").contains(program.channel_pattern.upper())
        & (F.to_date("join_time") < cutoff)
    ).select(
        F.col("member_detail_id"),
        rollup_partner("eff_reg_channel", program.rollup_cutoff_reg).alias("distributor_name"),
    )
    lines = orders.filter(
        (F.col("is_member") == program.member_yes)
        & (F.col("is_rrp_sales_type") == 1)
        & eff_line()
        & (F.to_date("date_id") < cutoff)
    )
    if program.distributors:
        lines = lines.filter(F.col("distributor_name").isin(list(program.distributors)))
    buy = lines.select(
        F.col("crm_member_id").alias("member_detail_id"),
        rollup_partner("distributor_name", program.rollup_cutoff_order).alias("distributor_name"),
    )
    return reg.unionByName(buy).distinct()


def reg_belong_rows(member_detail: DataFrame, program: Program, run_date: dt.date) -> DataFrame:
    """Registration branch of the daily belong date: (partner, member, join_time)."""
    return member_detail.filter(
        F.col("eff_reg_channel").contains(program.channel_pattern)
        & (F.col("join_time") < F.lit(run_date))
    ).select(
        rollup_partner("eff_reg_channel", program.rollup_daily_reg).alias("partner"),
        F.col("member_detail_id"),
        F.to_date("join_time").alias("belong_dt"),
    )


def order_belong_rows(orders: DataFrame, program: Program) -> DataFrame:
    """Purchase branch of the daily belong date: (partner, member, date_id)."""
    return rrp_lines(orders).filter(
        (F.col("is_member") == program.member_yes)
        & eff_line()
        & F.col("distributor_name").contains(program.channel_pattern)
    ).select(
        rollup_partner("distributor_name", program.rollup_daily_order).alias("partner"),
        F.col("crm_member_id").alias("member_detail_id"),
        F.to_date("date_id").alias("belong_dt"),
    )


def belong_by_partner(member_detail: DataFrame, orders: DataFrame, program: Program,
                      run_date: dt.date) -> DataFrame:
    """A4: first date a member belonged to each partner (by registration or purchase).

    MIN over the union of both branches equals MIN over the UNION of per-branch MINs,
    so one grouped pass is enough; partial aggregation runs before the shuffle.
    """
    rows = reg_belong_rows(member_detail, program, run_date).unionByName(order_belong_rows(orders, program))
    return rows.groupBy("partner", "member_detail_id").agg(F.min("belong_dt").alias("belong_by_partner_dt"))


def belong_overall(by_partner: DataFrame) -> DataFrame:
    """A5: first belong date over all partners, per member."""
    return by_partner.groupBy("member_detail_id").agg(
        F.min("belong_by_partner_dt").alias("belong_to_chn_dt"))
