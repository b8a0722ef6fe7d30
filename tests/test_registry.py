"""Registered queries against their SQL counterparts on the smallest test tables.

All of them, unless ``REGISTRY_STEP=n`` asks for every n-th.
"""

import os
import sys

import pytest

pytest.importorskip("duckdb")
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from drayline.registry import QUERIES  # noqa: E402

FOLDER = os.environ.get("REGISTRY_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


NAMES = list(QUERIES)[:: int(os.environ.get("REGISTRY_STEP", "1"))]


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    status, note, _ = compare.compare(spark, con, QUERIES[name], FOLDER)
    assert status == ("ok" if QUERIES[name].sql else "rows"), note


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    result = entry_points.entry(spark)
    assert "otd_rate_7d" in result.columns and not result.isEmpty()
