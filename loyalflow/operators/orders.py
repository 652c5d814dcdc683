"""Order-line metrics per member and partner (B18, B19, B22, B23, single pass).

All metrics read RRP lines only (``is_rrp_sales_type = 1``), which is pushed to the scan.
Order counts additionally need an effective line (``if_eff_order_tag IS TRUE``); net
sales do not.  Groups are on the *raw* member id; joins later cast it to int.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalflow.config import Program
from loyalflow.functions import rollup_partner
from loyalflow.operators.filters import key_filter, maybe_among

SALES_TYPE = "decimal(28,2)"


def eff_line() -> Column:
    """if_eff_order_tag IS TRUE (NULL counts as false)."""
    return F.coalesce(F.col("if_eff_order_tag"), F.lit(False))


def rrp_lines(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("is_rrp_sales_type") == 1)


def partner_col(program: Program) -> Column:
    return rollup_partner("distributor_name", program.rollup_daily_order)


def sales_in(program: Program) -> Column:
    """Member sales of a line with positive quantity, else 0."""
    member = F.col("is_member") == program.member_yes
    return F.when(member & (F.col("sales_qty") > 0), F.col("order_rrp_amt")).otherwise(F.lit(0))


def sales_out(program: Program) -> Column:
    """Member returns of a line with negative quantity (as a positive amount), else 0."""
    member = F.col("is_member") == program.member_yes
    return F.when(member & (F.col("sales_qty") < 0), F.abs("order_rrp_amt")).otherwise(F.lit(0))


def net_sales(program: Program) -> Column:
    """A10: SUM(member sales) - SUM(member returns)."""
    return (F.sum(sales_in(program)) - F.sum(sales_out(program))).cast(SALES_TYPE)


def orders_total(orders: DataFrame) -> DataFrame:
    """Distinct effective orders per member, over every partner (no channel filter)."""
    return (rrp_lines(orders).filter(eff_line())
            .groupBy("crm_member_id")
            .agg(F.count_distinct("original_order_id").alias("order_count")))


def orders_by_partner(orders: DataFrame, program: Program) -> DataFrame:
    """Distinct effective orders per (partner, member)."""
    return (rrp_lines(orders).filter(eff_line())
            .groupBy(partner_col(program).alias("partner"), "crm_member_id")
            .agg(F.count_distinct("original_order_id").alias("order_count")))


def net_sales_total(orders: DataFrame, program: Program) -> DataFrame:
    """Net member sales per member."""
    return rrp_lines(orders).groupBy("crm_member_id").agg(net_sales(program).alias("mbr_sales"))


def net_sales_by_partner(orders: DataFrame, program: Program) -> DataFrame:
    """Net member sales per (partner, member)."""
    return (rrp_lines(orders)
            .groupBy(partner_col(program).alias("partner"), "crm_member_id")
            .agg(net_sales(program).alias("mbr_sales")))


def metric_lines(orders: DataFrame, program: Program, also: list[Column] | None = None) -> DataFrame:
    eff = eff_line()
    belong = (eff & (F.col("is_member") == program.member_yes)
              & F.col("distributor_name").contains(program.channel_pattern))
    return rrp_lines(orders).select(
        *(also or []),
        partner_col(program).alias("partner"),
        "crm_member_id",
        "original_order_id",
        eff.alias("_eff"),
        sales_in(program).alias("_in"),
        sales_out(program).alias("_out"),
        belong.alias("_belong"),
        F.when(belong, F.to_date("date_id")).alias("_belong_dt"),
    )


def _level_metrics(lines: DataFrame, keys: list[str]) -> DataFrame:
    """One aggregate per level with a single distinct count: Spark plans it without an
    Expand; map-side it keeps one row per (keys, effective order) and folds every
    non-effective line of a group into one NULL-order row before the shuffle."""
    return lines.groupBy(*keys).agg(
        F.bool_or("_eff").alias("has_eff"),
        F.count_distinct(F.when(F.col("_eff"), F.col("original_order_id"))).alias("_orders"),
        (F.sum("_in") - F.sum("_out")).cast(SALES_TYPE).alias("mbr_sales"),
        F.bool_or("_belong").alias("has_belong"),
        F.min("_belong_dt").alias("belong_dt"),
    )


LINE_STATE = ("partner string, crm_member_id string, original_order_id string, _eff boolean, _in decimal(38,2), "
              "_out decimal(38,2), _belong boolean, _belong_dt date")


def condensed_lines(orders: DataFrame, program: Program, also: list[Column] | None = None) -> DataFrame:
    """Order lines as a state that merges exactly (A4 purchase branch, A6-A9): LINE_STATE, after the columns ``also``.

    One row for each (partner, member, effective order), and one with a NULL order for a group's other lines. States of
    any parts of the lines, put together, give the levels' metrics that the lines themselves give: sums are decimals,
    and an order that several parts hold is still one order.
    """
    lines = metric_lines(orders, program, also)
    names = [c for c in lines.columns if not c.startswith("_") and c != "original_order_id"]
    order = F.when(F.col("_eff"), F.col("original_order_id")).alias("original_order_id")
    return lines.groupBy(*names, order, "_eff").agg(
        F.sum("_in").cast("decimal(38,2)").alias("_in"), F.sum("_out").cast("decimal(38,2)").alias("_out"),
        F.bool_or("_belong").alias("_belong"), F.min("_belong_dt").alias("_belong_dt"))


def member_order_single_pass(orders: DataFrame, program: Program) -> DataFrame:
    """A4 (purchase branch), A6, A7, A8, A9: one aggregate per level instead of four.

    ``level`` = 'partner' rows are per (partner, member), 'member' rows per member over
    all partners.  Distinct order counts are not additive across partners (one order can
    carry several partners), so each level counts its own.  Order counts exist only where
    an effective line exists: ``has_eff`` carries that presence and ``order_count`` is
    NULL without it, as in the separate grouped queries.
    """
    return level_metrics(metric_lines(orders, program))


def level_metrics(lines: DataFrame) -> DataFrame:
    """Both levels of ``member_order_single_pass`` from its lines or from their state."""
    by_partner = _level_metrics(lines, ["partner", "crm_member_id"])
    by_member = _level_metrics(lines, ["crm_member_id"])
    by_partner = by_partner.withColumn("level", F.lit("partner"))
    by_member = by_member.withColumn("level", F.lit("member")).withColumn("partner", F.lit(None).cast("string"))
    return by_partner.unionByName(by_member).select(
        "level",
        "partner",
        "crm_member_id",
        "has_eff",
        F.when(F.col("has_eff"), F.col("_orders")).alias("order_count"),
        "mbr_sales",
        "has_belong",
        "belong_dt",
    )


def last_order_ranked(orders: DataFrame, program: Program) -> DataFrame:
    """The last effective order per (partner, member).

    ORDER BY paid time DESC with NULL as the largest value (a NULL paid time wins); the order id breaks ties.

    Two phases, so that the lines are never sorted: a hash aggregate finds each key's last paid time in fixed-width
    values; then only lines that a filter of these (key, time) pairs lets through are ranked, one row for each order.
    The filter may let other lines through, but never drops one of the last time, so the ranking stays exact.
    """
    key = ["partner", "crm_member_id"]
    lines = rrp_lines(orders).filter(eff_line() & F.col("crm_member_id").isNotNull()).select(
        partner_col(program).alias("partner"), "crm_member_id", "original_order_id", "order_paid_time")
    unpaid = F.col("order_paid_time").isNull()
    last = lines.groupBy(*key).agg(F.bool_or(unpaid).alias("_unpaid"), F.max("order_paid_time").alias("_time"))
    last_time = [F.col("partner"), F.col("crm_member_id"), F.col("_unpaid"), F.when(~F.col("_unpaid"), F.col("_time"))]
    tied = maybe_among(lines, [F.col("partner"), F.col("crm_member_id"), unpaid, F.col("order_paid_time")],
                       key_filter(last, last_time))
    per_order = tied.groupBy(*key, "original_order_id").agg(
        F.bool_or(unpaid).alias("_unpaid"), F.max("order_paid_time").alias("_time"))
    w = Window.partitionBy(*key).orderBy(
        F.col("_unpaid").desc(), F.col("_time").desc(), F.col("original_order_id").desc_nulls_last())
    top = per_order.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1)
    return top.select(*key, "original_order_id", F.when(~F.col("_unpaid"), F.col("_time")).alias("order_paid_time"))


def _listagg(c: Column) -> Column:
    """LISTAGG(DISTINCT c, ', ') in ascending order; NULL when no non-NULL value."""
    s = F.collect_set(c.cast("string"))
    return F.when(F.size(s) > 0, F.array_join(F.array_sort(s), ", "))


def last_order_details(orders: DataFrame, store: DataFrame, program: Program,
                       last_orders: DataFrame | None = None) -> DataFrame:
    """Lines of each partner's last orders, summarised per member and store.

    The join to the last orders is on (order, partner) only, as written: an order that
    is the last one for two members of a partner matches each line twice, and a second
    member on that order gets a row too.  Instead of materialising the duplicated
    lines, each line carries the number ``m`` of winners it matches and the number
    ``c`` of store rows with its (code, name); sums are scaled by ``m * c``, MIN and
    DISTINCT lists are unaffected.  Only lines of winning orders reach the aggregation:
    a fixed-size filter of the winners is applied at the scan, before the wide columns move.
    """
    if last_orders is None:
        last_orders = last_order_ranked(orders, program)
    winners = last_orders.groupBy("partner", "original_order_id").agg(F.count(F.lit(1)).alias("_m"))
    lines = rrp_lines(orders).filter(eff_line()).select(
        partner_col(program).alias("partner"),
        "crm_member_id", "original_order_id", "original_store_code", "date_id",
        "sku_id", "sku_name",
        sales_in(program).alias("_in"), sales_out(program).alias("_out"),
    )
    order = [F.col("partner"), F.col("original_order_id")]
    hit = maybe_among(lines, order, key_filter(winners, order)).join(winners, ["partner", "original_order_id"], "inner")
    per_store = hit.groupBy("partner", "crm_member_id", "original_order_id", "original_store_code", "_m").agg(
        F.min("date_id").alias("date_id"),
        _listagg(F.col("sku_id")).alias("sku_id"),
        _listagg(F.col("sku_name")).alias("sku_name"),
        F.sum("_in").alias("_in"),
        F.sum("_out").alias("_out"),
    )
    stores = store.groupBy(F.col("store_code").alias("original_store_code"), "store_name").agg(
        F.count(F.lit(1)).alias("_c"))
    out = per_store.join(stores, "original_store_code", "left")
    scale = F.col("_m") * F.coalesce(F.col("_c"), F.lit(1))
    return out.select(
        "partner", "crm_member_id", "original_order_id", "original_store_code", "store_name",
        "date_id", "sku_id", "sku_name",
        ((F.col("_in") - F.col("_out")) * scale).cast(SALES_TYPE).alias("mbr_sales"),
    )
