"""Column-level building blocks; every function returns a JVM-side ``Column`` expression."""

from loyalflow.functions.columns import (
    batch_date,
    flag,
    int_id,
    pad_id,
    strip_commas,
    tier_flag,
    tier_number,
)
from loyalflow.functions.rollup import rollup_partner

__all__ = [
    "batch_date",
    "flag",
    "int_id",
    "pad_id",
    "rollup_partner",
    "strip_commas",
    "tier_flag",
    "tier_number",
]
