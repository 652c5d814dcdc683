"""Loyalty-member migration analytics on Spark DataFrames."""

from loyalflow.config import FIXTURE_PROGRAM, Program, RunContext

__all__ = ["FIXTURE_PROGRAM", "Program", "RunContext"]
