"""The jobs against their oracle on inputs that the given tables don't hold: NULL labels, quantities and amounts,
member ids in several spellings, duplicate stores, list rows without a phone."""

from __future__ import annotations

import datetime as dt
import tempfile
from dataclasses import replace
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from loyalflow.config import FIXTURE_PROGRAM as P
from loyalflow.config import RunContext
from loyalflow.operators.orders import last_order_details
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import historical_base_flags
from loyalflow.plans.migration import K3_COLUMNS, migration_performance
from loyalflow.sources.fixtures import fixture_sources
from tests.conftest import SMALL
from tools.oracle_check import canon, duck

PAID = dt.datetime(2024, 1, 5, 9)


def _line(member, partner, order, qty="1", amount="10.00", eff=True, is_member="Y", paid=PAID, store="S1", sku="k"):
    return {"crm_member_id": member, "distributor_name": partner, "original_order_id": order, "order_paid_time": paid,
            "date_id": dt.date(2023, 12, 1), "original_store_code": store, "sku_id": sku, "sku_name": sku,
            "sales_qty": None if qty is None else Decimal(qty), "order_rrp_amt": None if amount is None else Decimal(amount),
            "is_member": is_member, "is_rrp_sales_type": 1, "if_eff_order_tag": eff}


E, G = "CHN E (E1)", "CHN G (G1)"
#: Member 12 is on the lists of E and H, member 3 on that of G.
LINES = [
    _line("12", E, "x1"), _line("12", E, "x1", sku="m"), _line("12", E, "x2", qty="-2", amount="-4.00"),
    _line("012", E, "x3"), _line("012", E, "x3", amount=None), _line("012", "CHN H (H1)", "x4"),
    _line("0012", E, "x5", eff=False), _line("0012", E, "x6", eff=None, amount="2.50"),
    _line("12", None, "x7"), _line(None, E, "x8"), _line(None, None, None),
    _line("3", G, "x9", qty=None), _line("3", G, "x10", qty="0"), _line("03", G, "x10", qty="0", amount=None, paid=None),
    _line("3", G, None, paid=None), _line("6", "CHN C (C1)", "x11", is_member=None), _line("6", "CHN C (C2)", "x11", store=None),
]
LISTS = {
    "list_c": [(None, dt.date(2020, 1, i % 28 + 1), "C1", "T3", None) for i in range(40)],
    "list_g": [(None,)] * 40,
    "list_j": [(None, None, "C1")] * 40 + [(None, None, "C2")],
    "high_tier": [(None, "CHN C (C1)"), (None, None)],
}


def _extended(sql: str, name: str, folder: str) -> str:
    """``sql`` with the rows of a Parquet folder added to one of its common tables."""
    at = sql.index(f"\n{name} AS (") + 1
    end, depth = sql.index("(", at), 0
    while True:
        depth += {"(": 1, ")": -1}.get(sql[end], 0)
        end += 1
        if not depth:
            break
    more = f", {name} AS (FROM given_{name} UNION ALL BY NAME FROM read_parquet('{folder}/*.parquet'))"
    return f"{sql[:at]}given_{sql[at:end]}{more}{sql[end:]}"


@pytest.fixture(scope="module")
def mutated(spark):
    src = fixture_sources(spark, SMALL)
    folder = tempfile.mkdtemp(prefix="loyalflow-mutated-")
    added = {"order_detail": (src.orders, [tuple(x[c] for c in src.orders.columns) for x in LINES]),
             "store": (src.store.select("store_code", "store_name"), [("S1", "Second name"), ("S1", "Second name"), ("S2", None), (None, "No code")])}
    added |= {k: (src.lists[k], rows) for k, rows in LISTS.items()}
    frames, oracle = {}, entry.oracle_sql()
    for name, (frame, rows) in added.items():
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)  # all may be NULL
        more = spark.createDataFrame(rows, schema)
        more.write.parquet(f"{folder}/{name}")
        frames[name] = frame.unionByName(more)
        oracle = {q: _extended(sql, name, f"{folder}/{name}") if f"\n{name} AS (" in sql else sql for q, sql in oracle.items()}
    lists = {**src.lists, **{k: frames[k] for k in LISTS}}
    return replace(src, orders=frames["order_detail"], store=frames["store"], lists=lists), oracle


def _same(df, sql):
    cols, want = duck(SMALL, sql)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want) > 0
    assert canon(df.columns, got) == canon(cols, want)


def test_last_order_details_on_mutated_inputs(mutated):
    src, oracle = mutated
    _same(last_order_details(src.orders, src.store, P), oracle["last_order_details"])


def test_jobs_on_mutated_inputs(mutated):
    src, oracle = mutated
    k1 = cutoff_group(src, P)
    _same(k1, oracle["cutoff_group_two"])
    k2 = historical_base_flags(src, P, k1)
    _same(k2, oracle["historical_base_flags"])
    k3 = migration_performance(src, P, k2, RunContext()).select(*K3_COLUMNS)
    _same(k3, oracle["migration_performance"])
    spelled = [r for r in k3.where("member_detail_id = '000000012' AND partner = 'CHN E (E1)'").collect()]
    assert len(spelled) > 16  # two or three spellings in each of the tables that meet
