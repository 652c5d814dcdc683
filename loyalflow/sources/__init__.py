"""Input tables of the three jobs.

``Sources`` bundles one DataFrame per input the jobs read (SURVEY S1-S27).  In production
each field is ``spark.table(...)`` / ``spark.read.parquet(...)`` of the real table;
``fixtures.fixture_sources`` derives every input from the driver's test tables.
"""

from loyalflow.sources.tables import Sources, read_table

__all__ = ["Sources", "read_table"]
