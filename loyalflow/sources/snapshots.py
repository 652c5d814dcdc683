"""Dated snapshots of a table: a run reads the latest one that is not after its date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

_PART = "snapshot_dt"


class SnapshotError(LookupError):
    """No snapshot for the run's date, or one whose columns aren't the expected ones in their order."""


def write_snapshot(df: DataFrame, root: str, table: str, day: dt.date) -> None:
    """Write one day's snapshot, in place of that day's former one."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{table}/{_PART}={day.isoformat()}")


def snapshot_days(spark: SparkSession, root: str, table: str) -> list[dt.date]:
    """The days that have a finished snapshot, from the folders' names alone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and s.getPath().getName().startswith(f"{_PART}=")]
    done = [p for p in folders if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(dt.date.fromisoformat(p.getName().split("=")[1]) for p in done)


def latest_snapshot(spark: SparkSession, root: str, table: str, run_date: dt.date, columns: list[str] | None = None) -> DataFrame:
    """The rows of the latest snapshot not after ``run_date``; only its folder is read.

    ``columns``: what the snapshot must have, in this order: unions of snapshots go by position, so a swapped pair would pass
    silently."""
    days = [d for d in snapshot_days(spark, root, table) if d <= run_date]
    if not days:
        raise SnapshotError(f"{table} has no snapshot on or before {run_date}")
    rows = spark.read.parquet(f"{root.rstrip('/')}/{table}/{_PART}={days[-1].isoformat()}")
    if columns is not None and rows.columns != columns:
        raise SnapshotError(f"{table} of {days[-1]} has the columns {rows.columns}, not {columns}")
    return rows
