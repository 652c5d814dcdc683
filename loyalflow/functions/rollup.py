"""Partner roll-up: the searched CASE that folds store-level channels into partners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loyalflow.config import Rollup


def _quote(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rollup_partner(column: str, rules: Rollup) -> Column:
    """Apply one roll-up rule set to a channel column.

    A CASE over literal IN-lists stays inside whole-stage codegen; the rule sets are a
    handful of labels, so there is nothing to gain from a lookup join.  It is handed
    over as one expression (one driver round trip).
    """
    col = f"`{column}`"
    probe = f"upper({col})" if rules.fold_case else col
    fallback = f"upper({col})" if rules.else_upper else col
    whens = " ".join(
        f"WHEN {probe} IN ({', '.join(_quote(m) for m in members)}) THEN {_quote(label)}"
        for members, label in rules.groups)
    return F.expr(f"CASE {whens} ELSE {fallback} END" if whens else fallback)
