"""The headline results as plain Spark SQL, each step by itself as the jobs describe it: the benchmark's baseline.

No shared aggregates, no spread keys, no filters of winners: one scan of the order lines for each fact, one DISTINCT or ranking for
each list. Only the partner roll-ups and the list shapes come from the library, being values rather than plans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.config import RunContext
from loyalflow.functions import rollup_partner
from loyalflow.operators import lists
from loyalflow.plans.historical_base import K2_COLUMNS
from loyalflow.sources import Sources
from loyalflow.sources.fixtures import fixture_sources

_MBR = "is_member = 'Y'"
_NET = (f"CAST(SUM(CASE WHEN {_MBR} AND sales_qty > 0 THEN order_rrp_amt ELSE 0 END) - "
        f"SUM(CASE WHEN {_MBR} AND sales_qty < 0 THEN abs(order_rrp_amt) ELSE 0 END) AS DECIMAL(28,2))")
_EFF = "is_rrp_sales_type = 1 AND if_eff_order_tag"
_RUN = RunContext()

VIEWS: dict[str, str] = {
    "cutoff_belong": f"""
        SELECT DISTINCT member_detail_id, p_cut AS distributor_name FROM v_member
        WHERE upper(eff_reg_channel) LIKE '%CHN%' AND to_date(join_time) < DATE'{P.cutoff_date}'
        UNION SELECT crm_member_id, p_cut FROM v_orders WHERE {_MBR} AND {_EFF} AND to_date(date_id) < DATE'{P.cutoff_date}'""",
    "cutoff_group": f"""
        SELECT l.distributor_name, m.member_detail_id
        FROM v_list_info l
        JOIN (SELECT phone, CAST(member_detail_id AS STRING) AS member_detail_id FROM v_member_phone WHERE phone_source_type = 0) m ON l.phone = m.phone
        LEFT JOIN cutoff_belong b ON CAST(m.member_detail_id AS INT) = CAST(b.member_detail_id AS INT) AND l.distributor_name = b.distributor_name
        LEFT JOIN v_wecom w ON CAST(m.member_detail_id AS INT) = CAST(w.member_id AS INT) AND l.distributor_name = w.distributor_name
        WHERE m.member_detail_id IN (SELECT member_detail_id FROM v_member WHERE to_date(join_time) < DATE'{P.cutoff_date}')
          AND b.member_detail_id IS NULL AND w.member_id IS NULL""",
    "k2": """
        SELECT DISTINCT b.*, e.encrypt_phone, CASE WHEN g.mid IS NULL THEN 0 ELSE 1 END AS if_not_belong_nor_wecom_by_partner,
               CASE WHEN t.mid IS NULL THEN 0 ELSE 1 END AS if_not_belong_nor_wecom_total
        FROM v_base b LEFT JOIN v_encrypt_phone e ON b.phone = e.phone
        LEFT JOIN v_crm_phone c ON e.encrypt_phone = c.phone
        LEFT JOIN (SELECT DISTINCT CAST(member_detail_id AS INT) AS mid, p_label FROM v_group) g ON CAST(c.member_detail_id AS INT) = g.mid AND b.partner = g.p_label
        LEFT JOIN (SELECT DISTINCT CAST(member_detail_id AS INT) AS mid FROM v_not_belong) t ON CAST(c.member_detail_id AS INT) = t.mid""",
    "belong": f"""
        SELECT partner, member_detail_id, min(dt) AS belong_dt FROM (
          SELECT p_day AS partner, member_detail_id, min(to_date(join_time)) AS dt FROM v_member
          WHERE eff_reg_channel LIKE '%CHN%' AND join_time < DATE'{_RUN.run_date}' GROUP BY 1, 2
          UNION SELECT p_day, crm_member_id, min(to_date(date_id)) FROM v_orders
          WHERE {_MBR} AND {_EFF} AND distributor_name LIKE '%CHN%' GROUP BY 1, 2) GROUP BY 1, 2""",
    "overall": "SELECT member_detail_id, min(belong_dt) AS belong_dt FROM belong GROUP BY 1",
    "orders_all": f"SELECT crm_member_id, count(DISTINCT original_order_id) AS n FROM v_orders WHERE {_EFF} GROUP BY 1",
    "sales_all": f"SELECT crm_member_id, {_NET} AS amt FROM v_orders WHERE is_rrp_sales_type = 1 GROUP BY 1",
    "orders_part": f"SELECT p_day AS partner, crm_member_id, count(DISTINCT original_order_id) AS n FROM v_orders WHERE {_EFF} GROUP BY 1, 2",
    "sales_part": f"SELECT p_day AS partner, crm_member_id, {_NET} AS amt FROM v_orders WHERE is_rrp_sales_type = 1 GROUP BY 1, 2",
    "metrics": f"""
        SELECT 'partner' AS level, s.partner, s.crm_member_id, o.n AS order_count, s.amt AS mbr_sales, b.belong_dt
        FROM sales_part s LEFT JOIN orders_part o ON s.partner <=> o.partner AND s.crm_member_id <=> o.crm_member_id
        LEFT JOIN (SELECT p_day AS partner, crm_member_id, min(to_date(date_id)) AS belong_dt FROM v_orders
                   WHERE {_MBR} AND {_EFF} AND distributor_name LIKE '%CHN%' GROUP BY 1, 2) b ON s.partner <=> b.partner AND s.crm_member_id <=> b.crm_member_id
        UNION ALL
        SELECT 'member', NULL, s.crm_member_id, o.n, s.amt, b.belong_dt FROM sales_all s LEFT JOIN orders_all o ON s.crm_member_id <=> o.crm_member_id
        LEFT JOIN (SELECT crm_member_id, min(to_date(date_id)) AS belong_dt FROM v_orders
                   WHERE {_MBR} AND {_EFF} AND distributor_name LIKE '%CHN%' GROUP BY 1) b ON s.crm_member_id <=> b.crm_member_id""",
    "last_order": f"""
        SELECT partner, crm_member_id, original_order_id FROM (
          SELECT p_day AS partner, crm_member_id, original_order_id, row_number() OVER (PARTITION BY p_day, crm_member_id
                 ORDER BY order_paid_time DESC NULLS FIRST, original_order_id DESC NULLS LAST) AS rk
          FROM v_orders WHERE {_EFF} AND crm_member_id IS NOT NULL) WHERE rk = 1""",
    "details": f"""
        SELECT l.p_day AS partner, l.crm_member_id, l.original_order_id, l.original_store_code, s.store_name, min(l.date_id) AS date_id,
               array_join(array_sort(collect_set(l.sku_id)), ', ') AS sku_id, array_join(array_sort(collect_set(l.sku_name)), ', ') AS sku_name, {_NET} AS mbr_sales
        FROM v_orders l JOIN last_order w ON l.original_order_id = w.original_order_id AND l.p_day = w.partner
        LEFT JOIN v_store s ON l.original_store_code = s.store_code
        WHERE {_EFF} GROUP BY 1, 2, 3, 4, 5""",
    "clerks": """
        SELECT DISTINCT b.member_detail_id, s.p_day AS partner_customized FROM v_relation r JOIN v_staff s ON r.staff_ext_id = s.staff_ext_id
        LEFT JOIN v_bind b ON r.external_user_unionid = b.id_value AND b.id_type = 'unionId' AND b.thirdparty_app_id = 4
        WHERE r.relation_deleted = 0 AND s.channel = 'CHN' AND s.store_code IS NOT NULL""",
    "person": """
        SELECT b.*, m.member_detail_id AS mbr_id, m.join_time, m.eff_reg_channel AS reg, m.eff_reg_store AS reg_store, m.store_name AS reg_name, m.tier_code, m.point,
               o.belong_dt AS belong_all, p.belong_dt AS belong_part, CAST(p.member_detail_id AS INT) AS here
        FROM v_k2 b LEFT JOIN v_crm_phone c ON b.encrypt_phone = c.phone
        LEFT JOIN v_member m ON CAST(c.member_detail_id AS INT) = CAST(m.member_detail_id AS INT)
        LEFT JOIN overall o ON CAST(c.member_detail_id AS INT) = CAST(o.member_detail_id AS INT)
        LEFT JOIN belong p ON CAST(c.member_detail_id AS INT) = CAST(p.member_detail_id AS INT) AND b.partner = p.partner""",
    "k3": """
        SELECT a.*, oa.n AS n_all, sa.amt AS amt_all, op.n AS n_part, sp.amt AS amt_part, d.date_id, d.original_store_code, d.store_name, d.sku_id, d.sku_name, d.mbr_sales, w.member_detail_id AS clerk
        FROM person a LEFT JOIN orders_all oa ON a.here = CAST(oa.crm_member_id AS INT) LEFT JOIN sales_all sa ON a.here = CAST(sa.crm_member_id AS INT)
        LEFT JOIN orders_part op ON a.here = CAST(op.crm_member_id AS INT) AND a.partner = op.partner
        LEFT JOIN sales_part sp ON a.here = CAST(sp.crm_member_id AS INT) AND a.partner = sp.partner
        LEFT JOIN details d ON a.here = CAST(d.crm_member_id AS INT) AND a.partner = d.partner
        LEFT JOIN clerks w ON a.here = CAST(w.member_detail_id AS INT) AND a.partner = w.partner_customized""",
}


def register(spark: SparkSession, sf_dir: str, src: Sources | None = None) -> None:
    """The inputs (those derived from the tables, if none are given) and steps as temporary views; nothing runs yet."""
    src = src or fixture_sources(spark, sf_dir)
    views = {
        "v_orders": src.orders.withColumns({"p_day": rollup_partner("distributor_name", P.rollup_daily_order), "p_cut": rollup_partner("distributor_name", P.rollup_cutoff_order)}),
        "v_member": src.member_detail.withColumns({"p_day": rollup_partner("eff_reg_channel", P.rollup_daily_reg), "p_cut": rollup_partner("eff_reg_channel", P.rollup_cutoff_reg)}),
        "v_list_info": src.list_info, "v_member_phone": src.member_phone, "v_encrypt_phone": src.encrypt_phone, "v_crm_phone": src.crm_member_phone,
        "v_not_belong": src.not_belong_total, "v_store": src.store, "v_relation": src.relation, "v_bind": src.bind,
        "v_staff": src.staff.withColumn("p_day", rollup_partner("distributor", P.rollup_daily_order)),
        "v_wecom": reduce(DataFrame.union, [s.filter(F.col("is_wecom_member") == 1) for s in src.wecom_snapshots]).toDF("distributor_name", "member_id", "is_wecom_member"),
        "v_base": reduce(DataFrame.unionByName, [lists.build_list(spec, src.lists, P) for spec in P.lists]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for name, sql in VIEWS.items():
        if name == "k2":
            spark.table("cutoff_group").withColumn("p_label", rollup_partner("distributor_name", P.rollup_relabel)).createOrReplaceTempView("v_group")
        spark.sql(sql).createOrReplaceTempView(name)
        if name == "k2":
            spark.table("k2").select(*K2_COLUMNS).createOrReplaceTempView("v_k2")


#: Headline query -> the view with its rows.
BASELINE = {
    "migration_performance": "k3", "historical_base_flags": "v_k2", "cutoff_group_two": "cutoff_group", "member_order_single_pass": "metrics",
    "last_order_details": "details", "belong_by_partner": "belong", "wecom_by_partner": "clerks", "historical_base_union": "v_base",
}
