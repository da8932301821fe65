"""Read stored tables back."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from sealframe.functions.text import cell
from sealframe.sinks.tables import check_name, quoted


def read_back(spark: SparkSession, database: str, table: str, columns: list[str]) -> DataFrame:
    """The named columns of a catalog table, in that order."""
    return spark.read.table(quoted(database, table)).select(*map(cell, columns))


def read_back_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], *,
                   predicates: list[str] | None = None, split_on: str | None = None, parts: int = 8,
                   properties: dict[str, str] | None = None) -> DataFrame:
    """The named columns of a database table.

    A table of tokens has no numeric key to split the read on: pass ``predicates``, one
    disjoint condition per connection, or the whole table comes through one connection. Where there is one, ``split_on`` names it: the
    database cuts its rows into ``parts`` of equal numbers, and each part is read by a connection of its own. A
    value that many rows have is a part by itself, as a condition on the key cannot split it.
    """
    check_name(table)
    if split_on is not None:
        if predicates is not None:
            raise ValueError("a read is split by predicates or on a column")
        found = spark.read.jdbc(url, bounds_query(table, split_on, parts), properties=properties or {}).collect()
        predicates = split_predicates(split_on, [r[0] for r in found])
    rows = spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
    return rows.select(*map(cell, columns))


def bounds_query(table: str, key: str, parts: int) -> str:
    """A derived table of at most ``parts`` rows that the database makes: where parts of equal numbers of rows begin.

    Strides of equal width, Spark's own way, put nearly all rows of a skewed key into one part.
    """
    if parts < 1:
        raise ValueError("a read has one part at least")
    key = check_name(key)
    return (f"(SELECT MIN(part_key) AS low FROM (SELECT {key} AS part_key, NTILE({parts}) OVER (ORDER BY {key}) AS part "
            f"FROM {check_name(table)} WHERE {key} IS NOT NULL) numbered GROUP BY part) bounds")


def split_predicates(key: str, lows: list) -> list[str]:
    """Disjoint conditions that cover every row, null keys too, from the least keys of the parts. A key that several parts begin with
    has too many rows for one: it gets a condition of its own."""
    key, starts = check_name(key), sorted(lows)
    edges = [v for i, v in enumerate(starts) if i == 0 or v != starts[i - 1]]
    hot = {v for v in edges if starts.count(v) > 1}
    if not edges:
        return ["1 = 1"]
    found = []
    for i, low in enumerate(edges):
        above = None if i + 1 == len(edges) else f"{key} < {_number(edges[i + 1])}"
        if low in hot:
            found.append(f"{key} = {_number(low)}")
            found.append(" AND ".join([f"{key} > {_number(low)}", *([above] if above else [])]))
        else:
            found.append(" AND ".join([f"{key} >= {_number(low)}", *([above] if above else [])]))
    # Keys below the first one came after it was read; nulls have no place of their own.
    return [f"{key} < {_number(edges[0])} OR {key} IS NULL", *found]


def _number(value) -> str:
    if isinstance(value, bool) or not isinstance(value, int | float | Decimal) or value != value or value in (float("inf"), float("-inf")):
        raise TypeError(f"a read is split on finite numbers, not on {value!r}")
    return repr(value) if isinstance(value, float) else str(value)
