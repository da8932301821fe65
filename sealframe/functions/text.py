"""Text form of a cell, the plaintext of its token."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T


def called(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` in a lambda, which Spark calls instead of inlining it into the generated code of the whole stage.

    The JVM compiles no method of over 8,000 bytes of bytecode but interprets it for as long as the query runs, many times
    slower; with what is done to a cell inlined, a few columns are enough. ``value`` is bound once.
    """
    return F.transform(F.array(value), make)[0]


def float_text(value: Column) -> Column:
    """Decimal text of a double in the notation of Python's ``str``.

    Spark's own cast agrees for zero and for magnitudes in [1e-3, 1e7). The rare rest is
    rewritten in a lambda, which Spark calls instead of inlining: inlined, it would push the
    generated code of a few columns past the size the JVM still compiles.
    """
    size = F.abs(value)
    usual = (size >= 1e-3) & (size < 1e7) | (size == 0)
    return F.when(usual, value.cast("string")).otherwise(called(value, _unusual_text))


def _unusual_text(value: Column) -> Column:
    plain, size = value.cast("string"), F.abs(value)
    positional = F.regexp_replace(plain.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
    exponent = F.regexp_replace(plain, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E(?=\d)", "e+")
    exponent = F.regexp_replace(exponent, "E-", "e-")
    exponent = F.regexp_replace(exponent, r"(?<=e[+-])(?=\d$)", "0")
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(exponent)
    )


def cell(name: str) -> Column:
    """Column by its exact name, dots and backticks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def cell_text(name: str, dtype: T.DataType, hide_nulls: bool = False) -> Column:
    """Plaintext of the cells of column ``name``.

    A null stays null, hence visible at rest, unless ``hide_nulls`` turns it into the text
    of a missing value (``nan`` in numeric columns, ``None`` elsewhere). A float has the text of
    the double with its shortest digits. Binary columns have no text and are refused.
    """
    if isinstance(dtype, T.BinaryType):
        raise TypeError(f"column {name} is binary; encode it as text first")
    if isinstance(dtype, T.DoubleType):
        text = float_text(cell(name))
    elif isinstance(dtype, T.FloatType):
        text = float_text(cell(name).cast("string").cast("double"))
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(cell(name).cast("string"))
    else:
        text = cell(name).cast("string")
    if hide_nulls:
        text = F.coalesce(text, F.lit("nan" if isinstance(dtype, T.NumericType) else "None"))
    return text
