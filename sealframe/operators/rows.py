"""Filter, projection, count and preview."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sealframe.functions.text import cell


def filter_category(df: DataFrame, category: str, value: str) -> DataFrame:
    """Rows of exactly that category: case and blanks count, null never matches."""
    return df.where(cell(category) == value)


def project_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns, in this order."""
    return df.select(*map(cell, columns))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def preview(df: DataFrame, n: int = 2, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows; without an order any ``n`` rows."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
