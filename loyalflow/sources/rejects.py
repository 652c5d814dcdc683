"""Member ids that can't be one: kept out of the jobs, listed, and counted while their table is written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class TooManyRejects(ValueError):
    """A table has more malformed ids than a run may have."""


@dataclass(frozen=True)
class Screened:
    """A table without its rejected rows, the side table (table_name, id, reason), and both counts."""

    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejects: int


def reject_reason(column: str) -> Column:
    """Why a member id can't be a join key: NULL where it can, or where it is NULL (which matches nothing)."""
    c = F.col(column)
    whole = F.trim(c.cast("string")).rlike(r"^[+-]?[0-9]+$")
    return F.when(c.isNull() | c.try_cast("int").isNotNull() & whole, F.lit(None).cast("string")) \
        .when(~whole, F.lit("not a whole number")).otherwise(F.lit("out of range"))


def screen(df: DataFrame, table: str, column: str, folder: str, most: float = 0.01) -> Screened:
    """Write ``df`` once, with rows whose ``column`` is malformed apart from the others, and read both parts back.

    The counts are observed by that same write, so nothing is scanned twice. More than ``most`` of the rows rejected: the
    table isn't what it should be, and ``TooManyRejects`` ends the run before any job reads it. An empty table passes.
    """
    seen = Observation(f"rejects of {table}")
    marked = df.withColumn("_reason", reject_reason(column))
    marked = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count("_reason").alias("bad"))
    path = f"{folder.rstrip('/')}/{table}"
    marked.withColumn("_part", F.when(F.col("_reason").isNull(), F.lit("rows")).otherwise(F.lit("rejects"))) \
        .write.mode("overwrite").partitionBy("_part").parquet(path)
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > most * n:
        raise TooManyRejects(f"{table}.{column}: {bad} of {n} ids are malformed, more than {most:.2%}")
    back = df.sparkSession.read.schema(f"{marked.schema.toDDL()}, _part string").parquet(path)
    rejects = back.filter(F.col("_part") == "rejects").select(F.lit(table).alias("table_name"), F.col(column).cast("string").alias("id"), F.col("_reason").alias("reason"))
    return Screened(back.filter(F.col("_part") == "rows").select(*df.columns), rejects, n, bad)


#: The member id of each input that has one.
ID_COLUMNS: Mapping[str, str] = {
    "orders": "crm_member_id", "member_detail": "member_detail_id", "crm_member_phone": "member_detail_id",
    "member_phone": "member_detail_id", "bind": "member_detail_id", "not_belong_total": "member_detail_id",
}
