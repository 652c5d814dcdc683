"""The input bundle and a plain parquet reader."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table under ``root``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


@dataclass
class Sources:
    """One DataFrame per input; column names as the jobs expect them (FIXTURES.md A).

    orders            order lines: crm_member_id, distributor_name, original_order_id,
                      order_paid_time, date_id, original_store_code, sku_id, sku_name,
                      sales_qty, order_rrp_amt, is_member, is_rrp_sales_type, if_eff_order_tag
    member_detail     member_detail_id, join_time, eff_reg_channel, eff_reg_store,
                      store_name, tier_code, point
    lists             partner list key -> list table (columns named in its ListSpec),
                      plus the side lists the specs name
    encrypt_phone     phone, encrypt_phone
    crm_member_phone  phone (encrypted), member_detail_id
    member_phone      member_detail_id, phone, phone_source_type
    list_info         phone, distributor_name (combined cutoff labels)
    wecom_snapshots   list of (distributor_name, member id, is_wecom_member) tables;
                      the member id column is the second column
    not_belong_total  member_detail_id
    store             store_code, store_name
    staff             staff_ext_id, store_code, distributor, channel, ...
    relation          external_user_unionid, staff_ext_id, relation_created_at,
                      relation_source, relation_deleted
    bind              member_detail_id, id_type, thirdparty_app_id, id_value
    """

    orders: DataFrame
    member_detail: DataFrame
    lists: Mapping[str, DataFrame]
    encrypt_phone: DataFrame
    crm_member_phone: DataFrame
    member_phone: DataFrame
    list_info: DataFrame
    store: DataFrame
    staff: DataFrame
    relation: DataFrame
    bind: DataFrame
    not_belong_total: DataFrame
    wecom_snapshots: list[DataFrame] = field(default_factory=list)
