"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
_OWNERS: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only on a local master where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="llm-scratch-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made within go when it ends: what reads them must have been written by then, outside of it."""
    _OWNERS.append([])
    try:
        yield
    finally:
        for path in _OWNERS.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table's folder, through Spark's own file system."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later steps don't recompute it,
    and a lost executor costs only its unfinished tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """``left`` LEFT JOIN ``right``, which has a row for each key; a key, or null, may hold a third of ``left``.

    Rows are dealt out over as many parts of their key as there are shuffle partitions, by a hash of ``by``. What
    is known of a key goes to the parts of it that there are, and rows meet it there: no task gets a whole key."""
    rows = left.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(tasks(left.sparkSession))).cast("int"))
    parts = rows.select(*keys, "_part").distinct().join(right, keys)
    return rows.join(parts, [*keys, "_part"], "left").drop("_part")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application; needed where it isn't installed there."""
    app = spark.conf.get("spark.app.id")
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        to = Path(tempfile.mkdtemp(prefix="llm-package-")) / f"{root.name}.zip"  # Spark sends it to the executors
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(to))
        _SHIPPED.add(app)
