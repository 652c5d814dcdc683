"""The three jobs in a row, each reading the table that the one before it wrote."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loyalflow.config import Program, RunContext
from loyalflow.plans.cutoff_group import cutoff_group
from loyalflow.plans.historical_base import historical_base_flags
from loyalflow.plans.migration import job_metrics, migration_performance
from loyalflow.plans.sinks import internal, reload_table, replace_table
from loyalflow.sources.tables import Sources


@dataclass(frozen=True)
class Targets:
    """Tables (``as_tables``) or folders that the run replaces; ``metrics`` is a work table of the last job."""

    group_two: str
    base: str
    metrics: str
    performance: str
    as_tables: bool = True


def run_pipeline(spark: SparkSession, src: Sources, program: Program, run: RunContext, to: Targets) -> DataFrame:
    """Replace K1, K2 and the metrics, then reload K3, whose table exists and keeps its columns; returns K3 as published."""
    group_names, base_names, k3_names = (program.names.get(t, {}) for t in ("group_two", "base", "performance"))

    def read(target: str) -> DataFrame:
        return spark.read.table(target) if to.as_tables else spark.read.parquet(target)

    replace_table(cutoff_group(src, program), to.group_two, to.as_tables, group_names)
    group_two = internal(read(to.group_two), group_names)
    replace_table(historical_base_flags(src, program, group_two), to.base, to.as_tables, base_names)
    replace_table(job_metrics(src, program), to.metrics, to.as_tables)
    base = internal(read(to.base), base_names)
    k3 = migration_performance(src, program, base, run, read(to.metrics))
    reload_table(k3, to.performance, to.as_tables, k3_names)
    if to.as_tables:
        spark.sql(f"DROP TABLE {to.metrics}")
    return read(to.performance)
