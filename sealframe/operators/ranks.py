"""Exact quantiles without gathering a column in one task.

``percentile`` keeps every distinct value of a group in one reducer. Here a value is found by
narrowing: count rows per slot of a coarse scale that preserves order, keep the slots that hold
a wanted rank, cut only those finer, and end with single values. Each pass aggregates map-side
first, so a value that makes up a third of all rows costs one partial row per task; what is
ordered in one task, broadcast or returned to the driver has a bound that the data cannot exceed.
Like ``approxQuantile`` this runs when called. Measures with few digits need one pass.
"""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from sealframe.functions.text import cell

# The coarse scale is logarithmic for every double but zero, which is a slot of its own: slots are
# about 1/1024 wide relative to the value, so there are some 750,000 for each sign at most.
SLOTS_PER_E = 1024
# Whole numbers beyond the logarithms of the smallest and of the largest double.
LEAST_LOG, MOST_LOG = -745, 710
# Parts a slot is cut into. A slot has at most about 2**43 doubles, fewer among the subnormal ones,
# so a part has at most about 2**23: that is what the last pass orders.
PARTS = 1 << 20


SPANS = pa.schema([
    ("span", pa.int32()), ("of", pa.string()), ("n", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()),
    ("wanted", pa.list_(pa.struct([("rank", pa.int64()), ("skip", pa.int64())]))),
])


@dataclass(frozen=True)
class Quantiles:
    """Rows that have a value, and one value per probability; none without rows."""

    n: int
    values: tuple[float | None, ...]
    least: float | None = None
    most: float | None = None


def present(v: Column) -> Column:
    """Neither null nor NaN."""
    return v.isNotNull() & ~F.isnan(v)


def exact_quantiles(df: DataFrame, columns: list[str] | tuple[str, ...],
                    probabilities: list[float] | tuple[float, ...]) -> dict[str, Quantiles]:
    """Quantiles of double columns, interpolated linearly between neighbouring values."""
    found: dict[tuple[str, int], float] = {}
    picks = _coarse_pass(df, columns, probabilities)
    totals = {pick.series: (pick.n, pick.least, pick.most) for pick in picks}
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    for cut in (F.floor((v - lo) / (hi - lo) * PARTS), v):
        found.update(((p.series, p.rank), p.lo) for p in picks if p.lo == p.hi)
        picks = [p for p in picks if p.lo != p.hi]
        if not picks:
            break
        picks = _finer_pass(df, picks, cut)
    found.update(((p.series, p.rank), p.lo) for p in picks)
    return {
        c: Quantiles(n, tuple(_interpolate(found, c, p * (n - 1)) if n else None for p in probabilities), least, most)
        for c in columns
        for n, least, most in [totals.get(c, (0, None, None))]
    }


def _long(df: DataFrame, columns) -> DataFrame:
    """The columns as rows ``(series, v)``."""
    return (
        df.select(*[cell(c).cast("double").alias(c) for c in columns])
        .unpivot([], [cell(c) for c in columns], "series", "v")
        .where(present(F.col("v")))
    )


def _extent() -> list[Column]:
    return [F.count("*").alias("rows"), F.min("v").alias("slot_lo"), F.max("v").alias("slot_hi")]


def _coarse_pass(df: DataFrame, columns, probabilities) -> list[Row]:
    """The slot of every wanted rank: at most two rows per column and probability."""
    v, n = F.col("v"), F.col("n")
    size = F.floor(F.least(F.log(F.abs(v)), F.lit(float(MOST_LOG))) * float(SLOTS_PER_E)) - LEAST_LOG * SLOTS_PER_E + 1
    scale = F.when(v > 0, size).when(v < 0, -size).otherwise(0)
    positions = [F.lit(float(p)) * (n - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*[side(p) for p in positions for side in (F.floor, F.ceil)]))
    by_series = Window.partitionBy("series")
    slots = (
        _long(df, columns)
        .groupBy("series", scale.alias("slot"))
        .agg(*_extent())
        .withColumn("n", F.sum("rows").over(by_series))
        .withColumn("least", F.min("slot_lo").over(by_series))
        .withColumn("most", F.max("slot_hi").over(by_series))
        .withColumn("before", F.sum("rows").over(by_series.orderBy("slot")) - F.col("rows"))
        .withColumn("wanted", F.transform(ranks, lambda r: F.struct(r.alias("rank"), r.alias("skip"))))
    )
    return _hits(slots, "least", "most")


def _finer_pass(df: DataFrame, picks: list[Row], cut: Column) -> list[Row]:
    """The same within the spans picked so far, reading only columns that are still open."""
    wanted: dict[tuple, list[dict]] = {}
    for p in picks:
        wanted.setdefault((p.series, p.n, p.lo, p.hi), []).append({"rank": p.rank, "skip": p.skip})
    rows = [dict(zip(SPANS.names, (i, *span, ranks))) for i, (span, ranks) in enumerate(wanted.items())]
    spans = df.sparkSession.createDataFrame(pa.Table.from_pylist(rows, schema=SPANS))
    # Constant bounds first: they reach the scan and leave few rows to unpivot.
    inside = functools.reduce(operator.or_, [cell(c).cast("double").between(lo, hi) for c, _, lo, hi in wanted])
    slots = (
        _long(df.where(inside), sorted({p.series for p in picks}))
        .join(F.broadcast(spans), (F.col("series") == F.col("of")) & F.col("v").between(F.col("lo"), F.col("hi")))
        .groupBy("span", cut.alias("slot"))
        .agg(*_extent())
        .withColumn("before", F.sum("rows").over(Window.partitionBy("span").orderBy("slot")) - F.col("rows"))
        .join(F.broadcast(spans.select("span", F.col("of").alias("series"), "n", "wanted")), "span")
    )
    return _hits(slots)


def _hits(slots: DataFrame, *more: str) -> list[Row]:
    skip, before = F.col("want.skip"), F.col("before")
    return (
        slots.withColumn("want", F.explode("wanted"))
        .where((before <= skip) & (skip < before + F.col("rows")))
        .select("series", "n", "want.rank", F.col("slot_lo").alias("lo"), F.col("slot_hi").alias("hi"),
                (skip - before).alias("skip"), *more)
        .collect()
    )


def _interpolate(found: dict[tuple[str, int], float], series: str, position: float) -> float:
    below, above = found[series, math.floor(position)], found[series, math.ceil(position)]
    share, step = position - math.floor(position), above - below
    if not share:
        return below
    # From the nearer neighbour, as numeric libraries do.
    return above - step * (1 - share) if share >= 0.5 else below + step * share
