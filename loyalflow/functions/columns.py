"""Scalar column expressions used across the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_commas(c: str | Column) -> Column:
    """Phones arrive with thousands separators; drop every comma."""
    return F.replace(_col(c), F.lit(","), F.lit(""))


def int_id(c: str | Column, strict: bool = True) -> Column:
    """Member id as an integer join key ('0012' and '12' meet).

    ``strict`` keeps the ANSI cast, so a non-numeric or out-of-range id fails the job as
    it would in the warehouse; otherwise such ids become NULL and never match.
    """
    c = _col(c)
    return c.cast("int") if strict else c.try_cast("int")


def pad_id(c: str | Column, width: int = 9) -> Column:
    """right(repeat('0', width) || id, width): left-pad with zeros, keep the *last* digits."""
    return F.right(F.concat(F.lit("0" * width), _col(c).cast("string")), F.lit(width))


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as not holding)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _quote(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tier_flag(tier: str, high_tiers: tuple[str, ...]) -> Column:
    """'1' for a high tier, '0' for anything else including NULL."""
    if not high_tiers:
        return F.lit("0")
    return F.expr(f"CASE WHEN `{tier}` IN ({', '.join(_quote(t) for t in high_tiers)}) THEN '1' ELSE '0' END")


def tier_number(tier: str, ranks: tuple[str, ...]) -> Column:
    """Position of the tier in ``ranks`` (1-based); NULL for unranked tiers."""
    if not ranks:
        return F.lit(None).cast("int")
    whens = " ".join(f"WHEN {_quote(name)} THEN {i}" for i, name in enumerate(ranks, start=1))
    return F.expr(f"CASE `{tier}` {whens} END")


def batch_date(ts: Column) -> Column:
    """Batch stamp text yyyyMMdd (Spark's 'mm' would be minutes)."""
    return F.date_format(ts, "yyyyMMdd")
