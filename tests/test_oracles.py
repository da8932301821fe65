"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest
from check_oracles import compare

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"


# The corpus package has tests of its own.
OWN = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_sql():
    assert set(OWN) <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    assert compare(spark, SF_DIR, name, contract.queries()[name], contract.oracle_sql()[name]) == ""


def test_entry(spark):
    rows = contract.entry(spark).collect()
    boxes = {(r.series, r.item): r.y for r in rows if r.chart == "box"}
    for m in contract.MEASURES:
        low, q1, median, q3, high = (boxes[m, i] for i in ("whisker_low", "q1", "median", "q3", "whisker_high"))
        assert low <= q1 <= median <= q3 <= high
    assert sum(r.n for r in rows if r.chart == "histogram") == sum(r.n for r in rows if r.chart == "scatter")
