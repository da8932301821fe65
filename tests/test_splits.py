"""Parts of equal numbers of rows, whatever the key looks like; the statement runs on an embedded engine."""

import random
from decimal import Decimal

import duckdb
import pytest

from sealframe.sources.tables import bounds_query, read_back_jdbc, split_predicates


def table(values):
    db = duckdb.connect()
    db.execute("CREATE TABLE t (k DOUBLE, r INTEGER)")
    db.executemany("INSERT INTO t VALUES (?, ?)", [(v, i) for i, v in enumerate(values)])
    return db


def parts_of(db, parts):
    lows = [r[0] for r in db.sql(f"SELECT * FROM {bounds_query('t', 'k', parts)}").fetchall()]
    return [{r[0] for r in db.sql(f"SELECT r FROM t WHERE {p}").fetchall()} for p in split_predicates("k", lows)]


SKEWED = {
    "long tail": lambda draw: [draw.paretovariate(0.3) for _ in range(2000)],
    "one value in a third": lambda draw: [7.0 if i % 3 == 0 else draw.gauss(0, 100) for i in range(2000)],
    "most in one": lambda draw: [1.0] * 1900 + [2.0, 3.0] + [None] * 98,
    "few values": lambda draw: [float(draw.randrange(3)) for _ in range(500)],
    "nulls": lambda draw: [None] * 20,
    "empty": lambda draw: [],
    "fewer rows than parts": lambda draw: [3.0, 1.0, None],
}


@pytest.mark.parametrize("kind", SKEWED)
@pytest.mark.parametrize("parts", [1, 2, 8])
def test_parts(kind, parts):
    values = SKEWED[kind](random.Random(1))
    found = parts_of(table(values), parts) if values else [set()]
    assert set().union(*found) == set(range(len(values))) and sum(map(len, found)) == len(values)
    share = -(-len([v for v in values if v is not None]) // parts) + 1
    for rows in found:
        keys = {values[r] for r in rows if values[r] is not None}
        assert len([r for r in rows if values[r] is not None]) <= 2 * share or len(keys) == 1


def test_strides_of_equal_width_fail_where_these_do_not():
    values = SKEWED["long tail"](random.Random(1))
    width = (max(values) - min(values)) / 8
    strides = [sum(min(values) + i * width <= v < min(values) + (i + 1) * width for v in values) for i in range(8)]
    assert max(strides) > 1900 and max(map(len, parts_of(table(values), 8))) <= 252


def test_statements():
    assert bounds_query("t", "k", 4) == ("(SELECT MIN(part_key) AS low FROM (SELECT k AS part_key, NTILE(4) OVER (ORDER BY k) AS part "
                                         "FROM t WHERE k IS NOT NULL) numbered GROUP BY part) bounds")
    assert split_predicates("k", [5, 1, 9]) == ["k < 1 OR k IS NULL", "k >= 1 AND k < 5", "k >= 5 AND k < 9", "k >= 9"]
    assert split_predicates("k", [1, 5, 5]) == ["k < 1 OR k IS NULL", "k >= 1 AND k < 5", "k = 5", "k > 5"]
    assert split_predicates("k", [Decimal("1.5")]) == ["k < 1.5 OR k IS NULL", "k >= 1.5"]
    assert split_predicates("k", []) == ["1 = 1"]
    for bad in ("x", float("nan"), True):
        with pytest.raises(TypeError):
            split_predicates("k", [bad])
    for args in (("t", "k; DROP", 2), ("t t", "k", 2), ("t", "k", 0)):
        with pytest.raises(ValueError):
            bounds_query(*args)
    with pytest.raises(ValueError, match="by predicates or on a column"):
        read_back_jdbc(None, "jdbc:none:", "t", ["k"], predicates=["1 = 1"], split_on="k")
