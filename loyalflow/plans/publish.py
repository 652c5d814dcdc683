"""The three jobs as a run that can be repeated, published at one moment.

A run has a folder of its own, ``runs/<run>``, with a table for each stage. A stage is finished when Spark's committer has left its
marker there, so a run that died is simply started again: it reads the finished stages and writes the others anew. When the last
table is written, the workload's invariants are counted in one pass over each written table. A run that holds them is
published by a new file in ``manifests``, with the next number: written under another name and then renamed, which fails where
the number is taken. Readers follow the manifest of the largest number. So they see the former table until that moment, whole,
and the new one after it, whole; nothing is ever overwritten while it can be read.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalflow.config import Program, RunContext
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import K2_COLUMNS, historical_base_flags
from loyalflow.plans.migration import BASE_PASS_THROUGH, K3_COLUMNS, job_metrics, migration_performance
from loyalflow.plans.sinks import internal, published
from loyalflow.sources.tables import Sources

STAGES = ("group_two", "base", "metrics", "performance")

#: Rows of K3 that must not exist. The last three compare values of one member, which holds while no id has two spellings.
K3_RULES: dict[str, str] = {
    "partner member outside the channel base": "if_partner_member_base = 1 AND if_chn_member_base = 0",
    "facts without partner membership": (
        "if_partner_member_base = 0 AND (ever_purchased_in_chn = 1 OR ever_purchased_in_partner = 1 OR ttl_rrp_sales_in_chn IS NOT NULL "
        "OR last_purchase_in_partner_dt IS NOT NULL OR add_partner_wecom = 1)"),
    "member id not of the fixed width": "length(member_detail_id) <> {width}",
    "belongs to a partner before the channel": "belong_to_chn_dt > belong_to_partner_dt",
    "bought in the partner, not in the channel": "ever_purchased_in_partner = 1 AND ever_purchased_in_chn = 0",
    "more orders in the partner than in the channel": "ttl_orders_in_partner > ttl_orders_in_chn",
}
K2_RULES: dict[str, str] = {"phone with a comma": "instr(phone, ',') > 0"}


class InvariantError(ValueError):
    """A run's tables break an invariant; it isn't published."""


@dataclass(frozen=True)
class Manifest:
    """A published run: its number, its name, its rows, how often each rule was broken, and the stages that this call wrote."""

    number: int
    run: str
    rows: int
    broken: dict[str, int]
    written: list[str] = field(default_factory=list)


class Store:
    """Files beside the tables, through Spark's own file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{path}"))

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{folder}")))

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{path}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that appears whole or, where there is one of its name, not at all."""
        made = self._path(f"{self.root}/{path}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(made, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.exists(path) or not self._fs.rename(made, self._path(f"{self.root}/{path}")):
            self._fs.delete(made, False)
            return False
        return True

    def remove(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.root}/{folder}"), True)


def run_name(program: Program, run: RunContext) -> str:
    """The same for the same clock reading and parameters, so that a repeated run finds its finished stages."""
    return f"{run.run_ts:%Y%m%dT%H%M%S}-{hashlib.sha256(repr(program).encode()).hexdigest()[:12]}"


def _count(rule: str) -> Column:
    return F.count(F.when(F.expr(rule), F.lit(1)))


def broken_rules(base: DataFrame, performance: DataFrame, program: Program) -> tuple[int, dict[str, int]]:
    """(rows of K3, how often each invariant is broken), from one aggregate over each table."""
    rows = F.count(F.lit(1)).alias("_rows")

    def counts(rules: dict[str, str]) -> list[Column]:
        return [_count(r.format(width=program.member_id_width)).alias(n) for n, r in rules.items()]

    def kinds(columns: list[str]) -> Column:
        """Different rows, told apart by 96 bits of hashes."""
        return F.count_distinct(F.xxhash64(*columns), F.hash(*columns))

    k2 = base.agg(rows, kinds(K2_COLUMNS).alias("_kinds"), kinds(BASE_PASS_THROUGH).alias("_passed"), *counts(K2_RULES)).first().asDict()
    k3 = performance.agg(rows, kinds(BASE_PASS_THROUGH).alias("_passed"), *counts(K3_RULES)).first().asDict()
    broken = {n: k2[n] for n in K2_RULES} | {n: k3[n] for n in K3_RULES}
    broken["repeated base row"] = k2["_rows"] - k2["_kinds"]
    broken["base row lost"] = max(0, k2["_passed"] - k3["_passed"])
    return k3["_rows"], broken


def manifests(spark: SparkSession, root: str) -> list[Manifest]:
    """Published runs, the latest one last."""
    store = Store(spark, root)
    files = [n for n in store.names("manifests") if n.endswith(".json")]
    return [Manifest(int(n.split(".")[0]), **json.loads(store.read(f"manifests/{n}"))) for n in files]


def current(spark: SparkSession, root: str, program: Program, table: str = "performance") -> DataFrame:
    """A table of the run that is published now, under its published names."""
    done = manifests(spark, root)
    if not done:
        raise ValueError(f"nothing is published under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/runs/{done[-1].run}/{table}")


def publish(spark: SparkSession, src: Sources, program: Program, run: RunContext, root: str,
            tolerated: frozenset[str] = frozenset()) -> Manifest:
    """Run the jobs into ``root`` and publish K3; starting again after a failure goes on with the first unfinished stage.

    ``tolerated``: rules that may be broken (the comparisons, where ids have several spellings). A run that is published
    already is only read again: its manifest is returned.
    """
    store, name = Store(spark, root), run_name(program, run)
    wrote: list[str] = []
    done = [m for m in manifests(spark, root) if m.run == name]
    if done:
        return done[-1]

    def stage(table: str, make: Callable[[], DataFrame]) -> DataFrame:
        names = program.names.get(table, {})
        if not store.exists(f"runs/{name}/{table}/_SUCCESS"):
            published(make(), names).write.mode("overwrite").parquet(f"{store.root}/runs/{name}/{table}")
            wrote.append(table)
        return internal(spark.read.parquet(f"{store.root}/runs/{name}/{table}"), names)

    group_two = stage("group_two", lambda: cutoff_group(src, program))
    base = stage("base", lambda: historical_base_flags(src, program, group_two))
    metrics = stage("metrics", lambda: job_metrics(src, program))
    k3 = stage("performance", lambda: migration_performance(src, program, base, run, metrics).select(*K3_COLUMNS))

    rows, broken = broken_rules(base, k3, program)
    bad = {n: k for n, k in broken.items() if k and n not in tolerated}
    if bad:
        raise InvariantError(f"run {name} isn't published: {bad}")
    text = json.dumps({"run": name, "rows": rows, "broken": broken, "written": wrote})
    number = len(manifests(spark, root))
    while not store.create(f"manifests/{number:08d}.json", text):  # another run was published meanwhile
        number += 1
    return Manifest(number, name, rows, broken, wrote)


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of published runs but the ``keep`` latest ones; a run that isn't published keeps its folder."""
    store, done = Store(spark, root), [m.run for m in manifests(spark, root)]
    old = [r for r in dict.fromkeys(done) if r not in done[-keep:] and store.exists(f"runs/{r}")]
    for r in old:
        store.remove(f"runs/{r}")
    return old


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: in ``spark.checkpoint.dir``; a temporary one only on a local master where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="loyalflow-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
