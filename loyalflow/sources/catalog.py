"""The jobs' inputs from a deployment's own tables and column names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.config import ListSpec, Program
from loyalflow.sources.snapshots import latest_snapshot
from loyalflow.sources.tables import Sources

#: The columns that the jobs read of each input, beside the lists, whose columns their specs name.
REQUIRED: dict[str, tuple[str, ...]] = {
    "orders": ("crm_member_id", "distributor_name", "original_order_id", "order_paid_time", "date_id", "original_store_code", "sku_id", "sku_name",
               "sales_qty", "order_rrp_amt", "is_member", "is_rrp_sales_type", "if_eff_order_tag"),
    "member_detail": ("member_detail_id", "join_time", "eff_reg_channel", "eff_reg_store", "store_name", "tier_code", "point"),
    "encrypt_phone": ("phone", "encrypt_phone"),
    "crm_member_phone": ("phone", "member_detail_id"),
    "member_phone": ("member_detail_id", "phone", "phone_source_type"),
    "list_info": ("phone", "distributor_name"),
    "store": ("store_code", "store_name"),
    "staff": ("staff_ext_id", "store_code", "distributor", "channel"),
    "relation": ("external_user_unionid", "staff_ext_id", "relation_created_at", "relation_deleted"),
    "bind": ("member_detail_id", "id_type", "thirdparty_app_id", "id_value"),
    "not_belong_total": ("member_detail_id",),
}


class MissingInputs(LookupError):
    """Tables or columns that the jobs need and the deployment doesn't name or have, all of them at once."""


@dataclass(frozen=True)
class Deployment:
    """Where a deployment keeps the inputs.

    ``tables``: catalog name of each input (``REQUIRED``), of each list (the specs' keys and side lists). ``columns``: for an
    input, the job's column name by the deployment's. ``snapshot_root``: a folder of dated snapshots; ``snapshots``: the inputs
    read from it instead of from the catalog, by table name there. ``wecom``: the dated wecom tables there, each with its
    three columns in the order of the union.
    """

    tables: Mapping[str, str]
    columns: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    snapshot_root: str | None = None
    snapshots: Mapping[str, str] = field(default_factory=dict)
    wecom: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)


def _list_columns(spec: ListSpec) -> dict[str, set[str]]:
    own = {c for c in (spec.phone, spec.tier, spec.join_dt, spec.channel, spec.city) if c}
    out = {spec.key: own}
    if spec.side:
        out[spec.side] = {"phone", *(c for c in (spec.side_tier, spec.side_distributor) if c)}
    return out


def catalog_sources(spark: SparkSession, where: Deployment, program: Program, run_date: dt.date) -> Sources:
    """``Sources`` over the deployment's tables, as of ``run_date`` for dated ones; only the columns that the jobs read are taken."""
    needed: dict[str, set[str]] = {name: set(cols) for name, cols in REQUIRED.items()}
    for spec in program.lists:
        for name, cols in _list_columns(spec).items():
            needed[name] = needed.get(name, set()) | cols
    missing: list[str] = []
    found: dict[str, DataFrame] = {}
    for name, cols in needed.items():
        if name in where.snapshots:
            df = latest_snapshot(spark, str(where.snapshot_root), where.snapshots[name], run_date)
        elif name not in where.tables or not spark.catalog.tableExists(where.tables[name]):
            missing.append(f"{name} ({where.tables.get(name, 'not named')})")
            continue
        else:
            df = spark.table(where.tables[name])
        df = df.withColumnsRenamed(dict(where.columns.get(name, {})))
        lacks = sorted(cols - set(df.columns))
        missing += [f"{name}.{c}" for c in lacks]
        if not lacks:
            found[name] = df.select(*(F.col(c) for c in df.columns if c in cols))
    if missing:
        raise MissingInputs("the jobs need " + ", ".join(missing))
    wecom = [latest_snapshot(spark, str(where.snapshot_root), table, run_date, list(cols)) for table, cols in where.wecom.items()]
    return Sources(lists={n: found[n] for n in needed if n not in REQUIRED}, wecom_snapshots=wecom, **{n: found[n] for n in REQUIRED})
