"""Table writers for the three outputs (K1-K3).

K1 and K2 replace their table (DROP + CREATE AS SELECT); K3 keeps its schema and is
fully reloaded with the columns in the published order.  Writes go to a path (or a
catalog table) through Spark's committer, so a lost executor only re-runs its tasks.
A job never overwrites a path it is reading: K3 reads K2, not K3.

A deployment publishes its columns by names of its own (``Program.names``): writers rename
on the way out, ``internal`` renames back where the next job reads the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalflow.plans.migration import K3_COLUMNS


def published(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """``df`` under its published column names, in the same order; a name for no column is a mistake."""
    unknown = set(names) - set(df.columns)
    if unknown:
        raise ValueError(f"published names for columns that the table doesn't have: {sorted(unknown)}")
    return df.select(*(F.col(c).alias(names.get(c, c)) for c in df.columns))


def internal(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A published table under the names that the jobs use."""
    return df.withColumnsRenamed({there: here for here, there in names.items()})


def replace_table(df: DataFrame, target: str, as_table: bool = False, names: Mapping[str, str] | None = None) -> None:
    """K1 / K2: replace the table with the query result."""
    writer = published(df, names or {}).write.mode("overwrite").format("parquet")
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def reload_table(df: DataFrame, target: str, as_table: bool = False, names: Mapping[str, str] | None = None) -> None:
    """K3: full refresh of a table whose column order is fixed (positional insert)."""
    ordered = published(df.select(*K3_COLUMNS), names or {})
    if as_table:
        ordered.write.insertInto(target, overwrite=True)
    else:
        ordered.write.mode("overwrite").format("parquet").save(target)
