"""Migration performance (B20-B24 -> K3): one wide row per historical-base row and member.

Shape of the plan:

* ``partner_profile`` - everything keyed by (member, partner): first belong date, order
  counts and net sales (total and per partner), last purchase, wecom connection.  One
  aggregate per level (partner, member) replaces the four grouped queries and the
  purchase branch of the belong date; with the last-order ranking and one read of the
  last orders' lines the order-line fact is scanned four times instead of seven.
* the base rows are resolved to members (encrypted phone), then joined to the member
  dimension and overall belong date on the int member id, then to ``partner_profile``
  on (int member id, partner).

Rows that cannot match (no encrypted phone, or no member behind it) keep NULL keys;
their rows are spread over the shuffle by ``left_join_spread`` instead of piling
into one partition.  Every join is LEFT, so every base row survives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalflow.config import Program, RunContext
from loyalflow.functions import batch_date, flag, int_id, pad_id
from loyalflow.operators.identity import phone_members
from loyalflow.operators.joins import left_join_spread
from loyalflow.operators.membership import reg_belong_rows
from loyalflow.operators.orders import (
    SALES_TYPE,
    last_order_details,
    last_order_ranked,
    member_order_single_pass,
)
from loyalflow.operators.wecom import wecom_pairs
from loyalflow.sources import Sources

K3_COLUMNS = [
    "phone", "partner", "distributor", "historical_join_dt", "historical_join_channel",
    "historical_vip_tier", "historical_city", "if_historical_high_vip_tier",
    "if_not_belong_nor_wecom_by_partner", "if_not_belong_nor_wecom_total",
    "if_joined_brand_by_cutoff",
    "if_joined_brand", "member_detail_id", "if_chn_member_base", "if_partner_member_base",
    "join_dt", "belong_to_chn_dt", "belong_to_partner_dt", "eff_reg_channel", "eff_reg_store",
    "eff_reg_store_name", "tier_code", "point",
    "ever_purchased_in_chn", "ttl_orders_in_chn", "ttl_rrp_sales_in_chn",
    "ever_purchased_in_partner", "ttl_orders_in_partner", "ttl_rrp_sales_in_partner",
    "last_purchase_in_partner_dt", "last_purchase_in_partner_store_code",
    "last_purchase_in_partner_store_name", "last_purchase_in_partner_sku_id",
    "last_purchase_in_partner_sku_name", "last_purchase_in_partner_rrp_sales",
    "add_partner_wecom",
    "dl_batch_date", "dl_load_time",
]

BASE_PASS_THROUGH = K3_COLUMNS[:10]


def job_metrics(src: Sources, program: Program) -> DataFrame:
    """The per-member order metrics that this job can match: lines without a member match no one."""
    return member_order_single_pass(src.orders.filter(F.col("crm_member_id").isNotNull()), program)


def member_metrics(src: Sources, program: Program, run: RunContext,
                   metrics: DataFrame | None = None) -> dict[str, DataFrame]:
    """The per-member / per-(partner, member) inputs of the wide table.

    Returns the registration rows of the belong date, belong_overall (A5), member totals
    (A6/A7 in one frame), partner facts (A4/A8/A9 in one frame), last_purchase (B19), wecom (B21).

    ``plans.pipeline.run_pipeline`` writes ``job_metrics`` to a named table first and passes
    it as ``metrics``; without it they are part of the plan, read once for each level and
    once for the overall belong date.
    """
    single = job_metrics(src, program) if metrics is None else metrics
    member_level = single.filter(F.col("level") == "member")
    # NULL partners join to nothing
    partner_level = single.filter((F.col("level") == "partner") & F.col("partner").isNotNull())

    registered = reg_belong_rows(src.member_detail, program, run.run_date)
    bought = partner_level.filter(F.col("has_belong")).select(F.col("crm_member_id").alias("member_detail_id"), "belong_dt")
    overall = registered.select("member_detail_id", "belong_dt").unionByName(bought) \
        .groupBy("member_detail_id").agg(F.min("belong_dt").alias("belong_to_chn_dt"))

    last = last_order_details(src.orders, src.store, program, last_order_ranked(src.orders, program))
    wecom = wecom_pairs(src, program, keep_unbound=False)
    return {
        "registered": registered,
        "belong_overall": overall,
        "member_level": member_level,
        "partner_level": partner_level,
        "last_purchase": last,
        "wecom": wecom,
    }


def _member_facts(m: dict[str, DataFrame], strict: bool) -> DataFrame:
    """(int id, partner): belong date, order count and net sales, one row per combination of the
    spellings that each of the three has.

    As written these are three tables joined on the int id, so an id spelled two ways
    ('01', '1') matches once per spelling in each.  Here one aggregate keeps the values of
    each as a list, as long as the id has spellings, and the lists are exploded one after
    another: the same rows from one read of the metrics and without the joins.
    """
    bought = m["partner_level"].select(
        "partner", F.col("crm_member_id").alias("member_detail_id"), "has_belong", "belong_dt",
        "order_count", "mbr_sales", F.lit(True).alias("sold"))
    registered = m["registered"].select(
        "partner", "member_detail_id", F.lit(True).alias("has_belong"), "belong_dt",
        F.lit(None).cast("bigint").alias("order_count"), F.lit(None).cast(SALES_TYPE).alias("mbr_sales"),
        F.lit(False).alias("sold"))
    spelled = bought.unionByName(registered).groupBy("partner", "member_detail_id").agg(
        F.bool_or("has_belong").alias("has_belong"),
        F.min("belong_dt").alias("belong_dt"),  # set on belonging rows only
        F.max("order_count").alias("order_count"),
        F.max("mbr_sales").alias("mbr_sales"),
        F.bool_or("sold").alias("sold"))
    keyed = spelled.withColumn("_mid", int_id("member_detail_id", strict)).filter(F.col("_mid").isNotNull())
    facts = keyed.groupBy("_mid", "partner").agg(
        F.collect_list(F.when(F.col("has_belong"), F.struct("belong_dt"))).alias("belongs"),
        F.collect_list("order_count").alias("counts"),
        F.collect_list(F.when(F.col("sold"), F.struct("mbr_sales"))).alias("sales"))
    return (facts
            .select("_mid", "partner", F.explode("belongs").alias("b"), "counts", "sales")
            .select("_mid", "partner", "b", F.explode_outer("counts").alias("ttl_orders_in_partner"), "sales")
            .select("_mid", "partner", "b", "ttl_orders_in_partner", F.explode_outer("sales").alias("s"))
            .select("_mid", "partner", F.col("b.belong_dt").alias("belong_by_partner_dt"),
                    "ttl_orders_in_partner", F.col("s.mbr_sales").alias("ttl_rrp_sales_in_partner")))


def _member_totals(m: dict[str, DataFrame], strict: bool) -> DataFrame:
    """int id: order count and net sales over all partners, by spelling as in ``_member_facts``."""
    keyed = m["member_level"].withColumn("_mid", int_id("crm_member_id", strict)).filter(F.col("_mid").isNotNull())
    totals = keyed.groupBy("_mid").agg(
        F.collect_list("order_count").alias("counts"), F.collect_list(F.struct("mbr_sales")).alias("sales"))
    return (totals
            .select("_mid", F.explode_outer("counts").alias("ttl_orders_in_chn"), "sales")
            .select("_mid", "ttl_orders_in_chn", F.explode("sales").alias("s"))
            .select("_mid", "ttl_orders_in_chn", F.col("s.mbr_sales").alias("ttl_rrp_sales_in_chn")))


def partner_profile(m: dict[str, DataFrame], program: Program) -> DataFrame:
    """Everything hanging off (member, partner) membership, keyed by (int id, partner)."""
    strict = program.strict_id_cast

    def keyed(df: DataFrame, id_col: str) -> DataFrame:
        return df.withColumn("_mid", int_id(id_col, strict)).drop(id_col)

    last = keyed(m["last_purchase"].select(
        "partner", "crm_member_id",
        F.col("date_id").alias("last_purchase_in_partner_dt"),
        F.col("original_store_code").alias("last_purchase_in_partner_store_code"),
        F.col("store_name").alias("last_purchase_in_partner_store_name"),
        F.col("sku_id").alias("last_purchase_in_partner_sku_id"),
        F.col("sku_name").alias("last_purchase_in_partner_sku_name"),
        F.col("mbr_sales").alias("last_purchase_in_partner_rrp_sales")), "crm_member_id")
    wecom = keyed(m["wecom"].select("member_detail_id", F.col("partner_customized").alias("partner")),
                  "member_detail_id").withColumn("_wc", F.lit(True))
    pp = (_member_facts(m, strict)
          .join(last, ["_mid", "partner"], "left")
          .join(wecom, ["_mid", "partner"], "left")
          .join(_member_totals(m, strict), ["_mid"], "left"))
    return pp.withColumn("_mbp", F.lit(True))


def resolved_profile(src: Sources, program: Program, base: DataFrame, overall: DataFrame,
                     by_partner: DataFrame) -> DataFrame:
    """Base rows with their members (LEFT, fans out), the member dimension, and overall / partner membership.

    ``base``: phone, partner, encrypt_phone and more; ``by_partner``: keyed by (_mid, partner), with ``_mbp``.
    """
    strict = program.strict_id_cast
    mbr = src.member_detail.select(
        int_id("member_detail_id", strict).alias("_mid"),
        F.col("member_detail_id").alias("_mbr_id"),
        "join_time", "eff_reg_channel", "eff_reg_store",
        F.col("store_name").alias("_mbr_store_name"), "tier_code", "point")
    overall = overall.select(
        int_id("member_detail_id", strict).alias("_mid"), "belong_to_chn_dt").withColumn("_mb", F.lit(True))
    spread = ["phone", "partner"]
    members, hot = phone_members(src.crm_member_phone), program.hot_key_share
    wide = left_join_spread(base, members, ["encrypt_phone"], spread, hot) \
        .withColumn("_mid", int_id("phone_member_id", strict))
    wide = left_join_spread(wide, [mbr, overall], ["_mid"], spread, hot)
    return left_join_spread(wide, by_partner, ["_mid", "partner"], spread, hot)


def profile_columns(program: Program) -> list[Column]:
    """Join and membership flags and dates of a row of ``resolved_profile``."""
    joined, in_base, in_partner = (F.col(c).isNotNull() for c in ("_mbr_id", "_mb", "_mbp"))
    return [
        flag(F.to_date("join_time") <= F.lit(program.cutoff_last_day)).alias("if_joined_brand_by_cutoff"),
        flag(joined).alias("if_joined_brand"),
        F.when(joined, pad_id("_mbr_id", program.member_id_width)).alias("member_detail_id"),
        flag(in_base).alias("if_chn_member_base"),
        flag(in_partner).alias("if_partner_member_base"),
        F.when(in_base, F.to_date("join_time")).alias("join_dt"),
        F.when(in_base, F.col("belong_to_chn_dt")).alias("belong_to_chn_dt"),
        F.when(in_partner, F.col("belong_by_partner_dt")).alias("belong_to_partner_dt"),
    ]


def migration_performance(src: Sources, program: Program, base: DataFrame,
                          run: RunContext | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """B24 + B25: the 38-column wide table (K3 column order)."""
    run = run or RunContext()
    m = member_metrics(src, program, run, metrics)
    pp = partner_profile(m, program)

    wide = resolved_profile(src, program, base.select(*BASE_PASS_THROUGH, "encrypt_phone"), m["belong_overall"], pp)
    in_partner = F.col("_mbp").isNotNull()
    # a TIMESTAMP_NTZ literal: the stamp does not move with the session time zone
    run_ts = F.expr(f"TIMESTAMP_NTZ '{run.run_ts.isoformat(sep=' ')}'")
    return wide.select(
        *BASE_PASS_THROUGH,
        *profile_columns(program),
        F.when(in_partner, F.col("eff_reg_channel")).alias("eff_reg_channel"),
        F.when(in_partner, F.col("eff_reg_store")).alias("eff_reg_store"),
        F.when(in_partner, F.col("_mbr_store_name")).alias("eff_reg_store_name"),
        F.when(in_partner, F.col("tier_code")).alias("tier_code"),
        F.when(in_partner, F.col("point")).alias("point"),
        flag(F.col("ttl_orders_in_chn").isNotNull()).alias("ever_purchased_in_chn"),
        "ttl_orders_in_chn",
        "ttl_rrp_sales_in_chn",
        flag(F.col("ttl_orders_in_partner").isNotNull()).alias("ever_purchased_in_partner"),
        "ttl_orders_in_partner",
        "ttl_rrp_sales_in_partner",
        "last_purchase_in_partner_dt", "last_purchase_in_partner_store_code",
        "last_purchase_in_partner_store_name", "last_purchase_in_partner_sku_id",
        "last_purchase_in_partner_sku_name", "last_purchase_in_partner_rrp_sales",
        flag(F.col("_wc").isNotNull()).alias("add_partner_wecom"),
        batch_date(run_ts).alias("dl_batch_date"),
        run_ts.alias("dl_load_time"),
    )
