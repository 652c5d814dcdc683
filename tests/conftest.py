from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from loyalflow.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app="loyalflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_src(spark):
    from loyalflow.sources.fixtures import fixture_sources

    return fixture_sources(spark, SMALL)


def rows(df, *cols):
    """Collected rows as sorted tuples (NULLs sort first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
