"""Inputs derived from the driver test tables (FIXTURES.md part B).

Every view is a DataFrame expression over ``customer``, ``supplier``, ``part``,
``orders``, ``lineitem`` and ``events``, so the work of each job grows with those tables.
The numeric rules (``k % 29`` ...) only decide which rows exercise which edge case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.config import (
    CHANNEL_LABELS,
    FIXTURE_COMBINED_LABEL,
    FIXTURE_LIST_NO,
    FIXTURE_PROGRAM,
    Program,
)
from loyalflow.sources.tables import Sources, read_table


def channel_label(k: Column) -> Column:
    """L(k): neutral channel label of a numeric code."""
    labels = F.array(*[F.lit(x) for x in CHANNEL_LABELS])
    return F.element_at(labels, (F.pmod(k, F.lit(len(CHANNEL_LABELS))) + 1).cast("int"))


def plain_phone(k: Column) -> Column:
    """PH: '13' followed by the key zero-padded to 9 digits."""
    return F.concat(F.lit("13"), F.lpad(k.cast("string"), 9, "0"))


def order_lines(spark: SparkSession, root: str) -> DataFrame:
    """One row per order line (lineitem JOIN orders LEFT JOIN part)."""
    li = read_table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus")
    od = read_table(spark, root, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    part = read_table(spark, root, "part").select("p_partkey", "p_name")
    lines = li.join(od, li.l_orderkey == od.o_orderkey, "inner").join(
        part, li.l_partkey == part.p_partkey, "left")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1.0)).otherwise(F.lit(1.0))
    member = (
        F.when(F.col("o_orderkey") % 29 == 0, F.lit(None).cast("bigint"))
        .when((F.col("l_linenumber") == 7) & (F.col("o_orderkey") % 5 == 0), F.col("o_custkey") + 1)
        .otherwise(F.col("o_custkey"))
    )
    return lines.select(
        member.cast("string").alias("crm_member_id"),
        channel_label(F.col("l_suppkey")).alias("distributor_name"),
        F.col("l_orderkey").cast("string").alias("original_order_id"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None)).otherwise(F.col("o_orderdate"))
        .alias("order_paid_time"),
        F.to_date("o_orderdate").alias("date_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("original_store_code"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        (F.col("l_quantity") * sign).cast("decimal(18,2)").alias("sales_qty"),
        (F.col("l_extendedprice") * sign).cast("decimal(18,2)").alias("order_rrp_amt"),
        F.when(F.col("o_orderstatus") == "P", F.lit("N")).otherwise(F.lit("Y")).alias("is_member"),
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(0)).alias("is_rrp_sales_type"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(False))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("boolean"))
        .otherwise(F.lit(True)).alias("if_eff_order_tag"),
    )


def member_detail(customer: DataFrame) -> DataFrame:
    """S3: member dimension; join times straddle the cutoff."""
    k = F.col("c_custkey")
    return customer.filter(k % 7 != 6).select(
        k.cast("string").alias("member_detail_id"),
        F.expr("TIMESTAMP_NTZ '2023-11-25 08:00:00' + make_dt_interval(CAST(c_custkey % 60 AS INT))")
        .alias("join_time"),
        channel_label(k).alias("eff_reg_channel"),
        F.concat(F.lit("S"), (k % 100).cast("string")).alias("eff_reg_store"),
        F.concat(F.lit("Store "), (k % 100).cast("string")).alias("store_name"),
        F.col("c_mktsegment").alias("tier_code"),
        F.floor("c_acctbal").cast("bigint").alias("point"),
    )


def hist_list(customer: DataFrame) -> DataFrame:
    """All partner lists in one view; ``list_no`` picks the partner.

    Copies: every key once in list k % 11; a second, different row (dup = 1) for k % 3 = 0;
    the same key in list (k + 3) % 11 for k % 4 = 0.
    """
    k = F.col("c_custkey")
    copies = reduce(DataFrame.unionByName, [
        customer.select(k.alias("k"), (k % 11).alias("list_no"), F.lit(0).alias("dup")),
        customer.filter(k % 3 == 0).select(k.alias("k"), (k % 11).alias("list_no"), F.lit(1).alias("dup")),
        customer.filter(k % 4 == 0).select(k.alias("k"), ((k + 3) % 11).alias("list_no"), F.lit(0).alias("dup")),
    ])
    k, dup = F.col("k"), F.col("dup")
    ph = plain_phone(k)
    kd = k + dup
    return copies.select(
        "list_no",
        k.alias("key"),
        F.when(k % 2 == 1, F.concat(ph.substr(1, 3), F.lit(","), ph.substr(4, 4), F.lit(","), ph.substr(8, 64)))
        .otherwise(ph).alias("phone"),
        F.when(kd % 13 == 0, F.lit(None).cast("string"))
        .when(kd % 17 == 0, F.lit("T?"))
        .otherwise(F.concat(F.lit("T"), (1 + kd % 5).cast("string"))).alias("tier"),
        F.when(kd % 9 == 0, F.lit(None).cast("date"))
        .otherwise(F.date_add(F.lit("2019-01-01").cast("date"), ((k * 7 + dup * 100) % 1500).cast("int")))
        .alias("join_dt"),
        F.concat(F.lit("C"), (k % 4).cast("string")).alias("channel"),
        F.concat(F.lit("City"), (kd % 6).cast("string")).alias("city"),
    )


LIST_TABLES = ("list_d", "list_e", "list_f", "list_g", "list_g_high", "list_h", "list_i", "list_c",
               "high_tier", "list_j", "list_a", "list_b", "list_k")


def _list_tables(hl: DataFrame) -> dict[str, DataFrame]:
    no = {v: k for k, v in FIXTURE_LIST_NO.items()}

    def rows(key: str) -> DataFrame:
        return hl.filter(F.col("list_no") == no[key])

    high = F.col("tier").isin("T3", "T4", "T5")
    return {
        "list_d": rows("list_d").select("phone", "tier"),
        "list_e": rows("list_e").select(
            F.col("phone").alias("phone_number"), F.col("join_dt").alias("historical_join_dt"),
            F.col("tier").alias("historical_vip_tier"), "city"),
        "list_f": rows("list_f").select("phone", F.col("join_dt").alias("historical_join_dt")),
        "list_g": rows("list_g").select("phone"),
        "list_g_high": rows("list_g").filter(high).select(
            "phone", F.col("tier").alias("historical_vip_tier")),
        "list_h": rows("list_h").select(
            "phone", F.col("channel").alias("historical_join_channel"),
            F.col("tier").alias("historical_vip_tier")),
        "list_i": rows("list_i").select(F.col("phone").alias("mobile"), F.col("tier").alias("grade")),
        "list_c": rows("list_c").select(
            "phone", F.col("join_dt").alias("historical_join_dt"),
            F.col("channel").alias("historical_join_channel"),
            F.col("tier").alias("historical_vip_tier"), F.col("city").alias("historical_city")),
        "high_tier": rows("list_c").filter(high).select(
            "phone",
            F.when(F.col("key") % 2 == 0, F.lit("CHN C (C1)")).otherwise(F.lit("CHN C (C2)"))
            .alias("distributor_name")),
        "list_j": rows("list_j").select(
            "phone", F.col("join_dt").alias("historical_join_dt"),
            F.col("channel").alias("historical_join_channel")),
        "list_a": rows("list_a").select(
            "phone", F.col("join_dt").alias("historical_join_dt"),
            F.col("channel").alias("historical_join_channel"), F.col("tier").alias("historical_vip_tier")),
        "list_b": rows("list_b").select(
            "phone", F.col("join_dt").alias("historical_join_dt"),
            F.col("channel").alias("historical_join_channel"), F.col("tier").alias("historical_vip_tier")),
        "list_k": rows("list_k").select("phone"),
    }


def _phone_tables(customer: DataFrame) -> dict[str, DataFrame]:
    k = F.col("c_custkey")
    ph = plain_phone(k)
    enc = F.md5(ph)
    crm = customer.filter(k % 10 != 8).select(
        enc.alias("phone"), F.lpad(k.cast("string"), 9, "0").alias("member_detail_id")
    ).unionByName(customer.filter(k % 50 == 0).select(
        enc.alias("phone"), (k + 1).cast("string").alias("member_detail_id")))
    mph = customer.filter(k % 10 != 8).select(
        k.alias("member_detail_id"), ph.alias("phone"), (k % 3).cast("int").alias("phone_source_type")
    ).unionByName(customer.filter(k % 50 == 0).select(
        (k + 1).alias("member_detail_id"), ph.alias("phone"), (k % 3).cast("int").alias("phone_source_type")))
    return {
        "encrypt_phone": customer.filter(k % 10 != 9).select(ph.alias("phone"), enc.alias("encrypt_phone")),
        "crm_member_phone": crm,
        "member_phone": mph,
        "not_belong_total": customer.filter(k % 4 == 1).select(k.cast("string").alias("member_detail_id")),
    }


def _store_tables(supplier: DataFrame) -> dict[str, DataFrame]:
    s = F.col("s_suppkey")
    code = F.concat(F.lit("S"), s.cast("string"))
    return {
        "store": supplier.filter(s % 13 != 0).select(code.alias("store_code"), F.col("s_name").alias("store_name")),
        "staff": supplier.select(
            s.alias("staff_ext_id"),
            F.col("s_name").alias("staff_name"),
            F.when(s % 13 == 0, F.lit(None).cast("string")).otherwise(code).alias("store_code"),
            F.col("s_name").alias("store_name"),
            channel_label(s).alias("distributor"),
            channel_label(s).alias("partner"),
            F.concat(F.lit("R"), F.col("s_nationkey").cast("string")).alias("region"),
            F.when(s % 6 == 0, F.lit("OTHER")).otherwise(F.lit("CHN")).alias("channel"),
        ),
    }


def _event_tables(events: DataFrame) -> dict[str, DataFrame]:
    u = F.col("user_id")
    relation = events.select(
        F.concat(F.lit("u"), u.cast("string")).alias("external_user_unionid"),
        (F.col("event_id") % 110).alias("staff_ext_id"),
        F.col("ts").alias("relation_created_at"),
        F.when(F.col("event_type") == "signup", F.lit(1)).otherwise(F.lit(0)).alias("relation_source"),
        F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)).alias("relation_deleted"),
    )
    bind = events.select("user_id").distinct().select(
        (u * 10).cast("string").alias("member_detail_id"),
        F.when(u % 11 == 0, F.lit("openId")).otherwise(F.lit("unionId")).alias("id_type"),
        F.when(u % 5 == 0, F.lit(3)).otherwise(F.lit(4)).alias("thirdparty_app_id"),
        F.concat(F.lit("u"), u.cast("string")).alias("id_value"),
    )
    return {"relation": relation, "bind": bind}


def list_info(hl: DataFrame) -> DataFrame:
    """List phones without separators, labelled with the combined cutoff label."""
    labels = F.create_map(*[x for no, key in FIXTURE_LIST_NO.items()
                            for x in (F.lit(no), F.lit(FIXTURE_COMBINED_LABEL[key]))])
    return hl.select(
        plain_phone(F.col("key")).alias("phone"),
        F.element_at(labels, F.col("list_no")).alias("distributor_name"),
    )


def wecom_snapshots(wecom_pairs: DataFrame) -> list[DataFrame]:
    """Dated snapshots of the wecom connections, cut by member id % 3.

    Labels go back to the combined cutoff form; members with id % 7 = 0 are
    stored as not connected (is_wecom_member = 0).
    """
    p = F.col("partner_customized")
    combined = (F.when(p == "CHN A", F.lit("CHN A (A1) and CHN A (A2)"))
                .when(p == "CHN B", F.lit("CHN B (B1) and CHN B (B2)"))
                .when(p == "CHN C (C1) & CHN C (C2)", F.lit("CHN C (C1) and CHN C (C2)"))
                .otherwise(p))
    mid = F.col("member_detail_id").cast("bigint")
    snap = wecom_pairs.filter(F.col("member_detail_id").isNotNull()).select(
        combined.alias("distributor_name"),
        F.col("member_detail_id"),
        F.when(mid % 7 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_wecom_member"),
        (mid % 3).alias("part"),
    )
    part1 = snap.filter("part = 0").select("distributor_name", F.col("member_detail_id").alias("member_id"),
                                           "is_wecom_member")
    part2 = snap.filter("part = 1").select("distributor_name", F.col("member_detail_id").alias("member_id"),
                                           "is_wecom_member")
    part3 = snap.filter("part = 2").select("distributor_name", "member_detail_id", "is_wecom_member")
    return [part1, part2, part3]


def fixture_sources(spark: SparkSession, root: str, program: Program = FIXTURE_PROGRAM) -> Sources:
    """The jobs' inputs as lazy expressions over the given tables: nothing is written or kept between calls."""
    customer = read_table(spark, root, "customer")
    supplier = read_table(spark, root, "supplier")
    events = read_table(spark, root, "events")
    hl = hist_list(customer)
    phones = _phone_tables(customer)
    stores = _store_tables(supplier)
    ev = _event_tables(events)
    src = Sources(
        orders=order_lines(spark, root),
        member_detail=member_detail(customer),
        lists=_list_tables(hl),
        encrypt_phone=phones["encrypt_phone"],
        crm_member_phone=phones["crm_member_phone"],
        member_phone=phones["member_phone"],
        list_info=list_info(hl),
        store=stores["store"],
        staff=stores["staff"],
        relation=ev["relation"],
        bind=ev["bind"],
        not_belong_total=phones["not_belong_total"],
    )
    from loyalflow.operators.wecom import wecom_pairs

    src.wecom_snapshots = wecom_snapshots(wecom_pairs(src, program))
    return src
