"""Named queries, one per operator group of the survey (each over the whole fixture tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM, RunContext
from loyalflow.functions import flag, int_id, pad_id, rollup_partner
from loyalflow.operators import identity, lists, membership, orders, wecom
from loyalflow.operators.joins import left_join_spread_hot
from loyalflow.plans import daily_state, migration, publish
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import historical_base_flags
from loyalflow.plans.migration import K3_COLUMNS, migration_performance
from loyalflow.sources import Sources, layout, rejects, snapshots
from loyalflow.sources.fixtures import fixture_sources

P = FIXTURE_PROGRAM
RUN = RunContext()

QueryFn = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, root: str) -> Sources:
    return fixture_sources(spark, root, P)


def _lists(keys: list[str]) -> QueryFn:
    def q(spark: SparkSession, root: str) -> DataFrame:
        src = _src(spark, root)
        return reduce(DataFrame.unionByName, [lists.build_list(P.list_spec(k), src.lists, P) for k in keys])
    return q


def partner_rollup_cutoff_reg(spark, root):
    src = _src(spark, root)
    md = src.member_detail.filter(
        F.upper("eff_reg_channel").contains(P.channel_pattern.upper())
        & (F.to_date("join_time") < F.lit(P.cutoff_date)))
    return md.groupBy("eff_reg_channel",
                      rollup_partner("eff_reg_channel", P.rollup_cutoff_reg).alias("distributor_name")
                      ).agg(F.count(F.lit(1)).alias("n_members"))


def partner_rollup_cutoff_order(spark, root):
    src = _src(spark, root)
    lines = src.orders.filter(
        (F.col("is_member") == P.member_yes) & (F.col("is_rrp_sales_type") == 1) & orders.eff_line()
        & (F.to_date("date_id") < F.lit(P.cutoff_date)))
    return lines.groupBy(F.col("distributor_name").alias("raw_distributor"),
                         rollup_partner("distributor_name", P.rollup_cutoff_order).alias("distributor_name")
                         ).agg(F.count(F.lit(1)).alias("n_lines"))


def partner_rollup_relabel(spark, root):
    src = _src(spark, root)
    return cutoff_group(src, P).select(
        rollup_partner("distributor_name", P.rollup_relabel).alias("partner"), "member_detail_id").distinct()


def partner_rollup_daily_order(spark, root):
    src = _src(spark, root)
    return orders.rrp_lines(src.orders).groupBy(
        F.col("distributor_name").alias("raw_distributor"), orders.partner_col(P).alias("partner")
    ).agg(F.count(F.lit(1)).alias("n_lines"))


def partner_rollup_daily_reg(spark, root):
    src = _src(spark, root)
    md = src.member_detail.filter(
        F.col("eff_reg_channel").contains(P.channel_pattern) & (F.col("join_time") < F.lit(RUN.run_date)))
    return md.groupBy("eff_reg_channel",
                      rollup_partner("eff_reg_channel", P.rollup_daily_reg).alias("partner")
                      ).agg(F.count(F.lit(1)).alias("n_members"))


def historical_base_union(spark, root):
    src = _src(spark, root)
    return lists.historical_base(src.lists, P)


def cutoff_belong(spark, root):
    src = _src(spark, root)
    return membership.cutoff_belong(src.member_detail, src.orders, P)


def wecom_snapshot_union(spark, root):
    src = _src(spark, root)
    return wecom.wecom_snapshot_union(src.wecom_snapshots)


def cutoff_group_two(spark, root):
    return cutoff_group(_src(spark, root), P)


def last_order_ranked(spark, root):
    return orders.last_order_ranked(_src(spark, root).orders, P)


def last_order_details(spark, root):
    src = _src(spark, root)
    return orders.last_order_details(src.orders, src.store, P)


def belong_by_partner(spark, root):
    src = _src(spark, root)
    return membership.belong_by_partner(src.member_detail, src.orders, P, RUN.run_date)


def belong_overall(spark, root):
    src = _src(spark, root)
    return membership.belong_overall(membership.belong_by_partner(src.member_detail, src.orders, P, RUN.run_date))


def wecom_by_partner(spark, root):
    return wecom.wecom_pairs(_src(spark, root), P, keep_unbound=True)


def orders_total(spark, root):
    return orders.orders_total(_src(spark, root).orders)


def orders_by_partner(spark, root):
    return orders.orders_by_partner(_src(spark, root).orders, P)


def net_sales_total(spark, root):
    return orders.net_sales_total(_src(spark, root).orders, P)


def net_sales_by_partner(spark, root):
    return orders.net_sales_by_partner(_src(spark, root).orders, P)


def member_order_single_pass(spark, root):
    return orders.member_order_single_pass(_src(spark, root).orders, P).drop("has_eff", "has_belong")


def identity_resolution(spark, root):
    src = _src(spark, root)
    base = lists.historical_base(src.lists, P)
    return identity.identity_resolution(base, src.encrypt_phone, src.crm_member_phone)


def padded_member_id(spark, root):
    src = _src(spark, root)
    return src.crm_member_phone.select(
        F.col("member_detail_id").alias("raw_member_id"),
        pad_id("member_detail_id", P.member_id_width).alias("member_detail_id"),
    ).distinct()


def _k1(src: Sources) -> DataFrame:
    """Cutoff group (K1).  Read once by the next job, so it stays part of one plan here;
    a deployment writes it with ``sinks.replace_table`` and the next job reads the table."""
    return cutoff_group(src, P)


def _k2(src: Sources) -> DataFrame:
    """Historical base (K2), same hand-over as K1."""
    return historical_base_flags(src, P, _k1(src))


def historical_base_flags_q(spark, root):
    src = _src(spark, root)
    return historical_base_flags(src, P, _k1(src))


def member_profile_flags(spark, root):
    """Base -> member -> member dimension / overall / partner belong."""
    src = _src(spark, root)
    base = _k2(src).select("phone", "partner", "encrypt_phone")
    mbp = membership.belong_by_partner(src.member_detail, src.orders, P, RUN.run_date)
    by_partner = mbp.select(int_id("member_detail_id").alias("_mid"), "partner", "belong_by_partner_dt") \
        .withColumn("_mbp", F.lit(True))
    wide = migration.resolved_profile(src, P, base, membership.belong_overall(mbp), by_partner)
    return wide.select("phone", "partner", *migration.profile_columns(P)).drop("join_dt")


def migration_performance_q(spark, root):
    src = _src(spark, root)
    return migration_performance(src, P, _k2(src), RUN).select(*K3_COLUMNS)


def publish_batch_stamp(spark, root):
    src = _src(spark, root)
    k3 = migration_performance(src, P, _k2(src), RUN)
    return k3.groupBy("dl_batch_date", "dl_load_time").agg(F.count(F.lit(1)).alias("n_rows"))


def published_performance(spark, root):
    """K1 -> K2 -> K3 through tables, checked and published; then the table that a reader finds."""
    folder = publish.work_folder(spark, "publish")
    publish.publish(spark, _src(spark, root), P, RUN, folder)
    return publish.current(spark, folder, P)


#: Days whose first load lacks lines, and that are applied again: from this one on.
RESTATED_FROM = dt.date(2000, 1, 1)
#: Run dates of the backfill.
BACKFILL = [dt.date(1996 + m // 12, 1 + m % 12, 1) for m in range(30)]


def daily_state_refresh(spark, root):
    """A first load in which late days lack their returns, then those days restated, one part of them after the other."""
    orders, folder = _src(spark, root).orders, publish.work_folder(spark, "daily-state")
    days = [RESTATED_FROM + dt.timedelta(days=k) for k in range(240)]
    late = F.coalesce(F.to_date("date_id").between(F.lit(days[0]), F.lit(days[-1])), F.lit(False))
    daily_state.apply_days(spark, orders.filter(~late | (F.col("sales_qty") > 0)), P, folder)
    for some in (days[:80], days[80:]):
        daily_state.apply_days(spark, orders, P, folder, some)
    return daily_state.metrics(spark, folder).drop("has_eff", "has_belong")


def metrics_backfill(spark, root):
    """Order metrics as of 30 run dates, from one read of the fact."""
    folder = publish.work_folder(spark, "backfill")
    daily_state.apply_days(spark, _src(spark, root).orders, P, folder)
    return daily_state.metrics_as_of(daily_state.read_state(spark, folder), BACKFILL)


def rejected_ids(spark, root):
    """Phone rows of which some have a malformed member id: the side table of what a run leaves out."""
    rows = _src(spark, root).crm_member_phone
    k = F.col("member_detail_id").cast("int")
    made = F.when(k % 40 == 0, F.concat(F.lit("x"), "member_detail_id")).when(k % 41 == 0, F.concat("member_detail_id", F.lit("9999999999")))
    rows = rows.withColumn("member_detail_id", F.coalesce(made, "member_detail_id"))
    return rejects.screen(rows, "crm_member_phone", "member_detail_id", publish.work_folder(spark, "rejects"), most=0.1).rejects


def cutoff_group_dated(spark, root):
    """K1 from dated snapshots: an older one with fewer members, the one that counts, and one after the run date."""
    src, folder = _src(spark, root), publish.work_folder(spark, "snapshots")
    taken = []
    for k, snap in enumerate(src.wecom_snapshots):
        day, member = RUN.run_date, snap.columns[1]
        for when, rows in ((day - dt.timedelta(days=9), snap.filter(F.xxhash64(member) % 2 == 0)), (day, snap), (day + dt.timedelta(days=1), snap.limit(0))):
            snapshots.write_snapshot(rows, folder, f"wecom_{k}", when)
        taken.append(snapshots.latest_snapshot(spark, folder, f"wecom_{k}", day, snap.columns))
    return cutoff_group(replace(src, wecom_snapshots=taken), P)


def hot_phone_identity(spark, root):
    """J11, J12 where a third of all list rows have the same phone: rows and matches of each partner."""
    src = _src(spark, root)
    base = lists.historical_base(src.lists, P).select("partner", "phone", "historical_city")
    third = F.pmod(F.right("phone", F.lit(7)).cast("int"), F.lit(3)) == 0
    base = base.withColumn("own", F.col("phone")).withColumn("phone", F.when(third, F.lit("13000000007")).otherwise(F.col("phone")))
    coded = left_join_spread_hot(base, src.encrypt_phone, ["phone"], ["own", "partner"])
    known = left_join_spread_hot(coded, identity.phone_members(src.crm_member_phone), ["encrypt_phone"], ["own", "partner"])
    return known.groupBy("partner").agg(F.count(F.lit(1)).alias("n_rows"), F.count("encrypt_phone").alias("n_encrypted"), F.count("phone_member_id").alias("n_members"))


def member_orders_bucketed(spark, root):
    """The order metrics from the fact as it is laid out for them: by member and month."""
    folder = publish.work_folder(spark, "layout")
    name = folder.rsplit("-", 1)[1]
    to = layout.Layout(f"lines_{name}", f"heavy_lines_{name}")
    layout.write_layout(_src(spark, root).orders, to, folder, buckets=8)
    return layout.metrics(spark, to, P).drop("has_eff", "has_belong")


QUERIES: dict[str, QueryFn] = {
    "partner_rollup_cutoff_reg": partner_rollup_cutoff_reg,
    "partner_rollup_cutoff_order": partner_rollup_cutoff_order,
    "partner_rollup_relabel": partner_rollup_relabel,
    "partner_rollup_daily_order": partner_rollup_daily_order,
    "partner_rollup_daily_reg": partner_rollup_daily_reg,
    "list_tier_flag": _lists(["list_d", "list_h", "list_i", "list_b"]),
    "list_lowest_tier": _lists(["list_e", "list_a"]),
    "list_latest_join": _lists(["list_f"]),
    "list_default_tier_join": _lists(["list_g"]),
    "list_flag_from_match": _lists(["list_c"]),
    "list_phone_only": _lists(["list_j", "list_k"]),
    "historical_base_union": historical_base_union,
    "cutoff_belong": cutoff_belong,
    "wecom_snapshot_union": wecom_snapshot_union,
    "cutoff_group_two": cutoff_group_two,
    "last_order_ranked": last_order_ranked,
    "last_order_details": last_order_details,
    "belong_by_partner": belong_by_partner,
    "belong_overall": belong_overall,
    "wecom_by_partner": wecom_by_partner,
    "orders_total": orders_total,
    "orders_by_partner": orders_by_partner,
    "net_sales_total": net_sales_total,
    "net_sales_by_partner": net_sales_by_partner,
    "member_order_single_pass": member_order_single_pass,
    "identity_resolution": identity_resolution,
    "padded_member_id": padded_member_id,
    "historical_base_flags": historical_base_flags_q,
    "member_profile_flags": member_profile_flags,
    "migration_performance": migration_performance_q,
    "publish_batch_stamp": publish_batch_stamp,
    "published_performance": published_performance,
    "daily_state_refresh": daily_state_refresh,
    "metrics_backfill": metrics_backfill,
    "rejected_ids": rejected_ids,
    "cutoff_group_dated": cutoff_group_dated,
    "hot_phone_identity": hot_phone_identity,
    "member_orders_bucketed": member_orders_bucketed,
}
