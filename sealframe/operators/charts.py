"""The numbers behind a scatter plot, a histogram and box plots.

Missing values (null and NaN) are not drawn and not counted. Ranges and quartiles are found
when the function is called; what they say goes into the returned plan as plain constants.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sealframe.functions.text import cell
from sealframe.operators.ranks import exact_quantiles, present
from sealframe.operators.sketches import approximate_quantiles

# Quartiles, the reach of the whiskers in interquartile ranges, bins.
QUARTILES = (0.25, 0.5, 0.75)
REACH = 1.5
BINS = 10


def scatter_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct points and how often each occurs: the same picture without overplotting."""
    points = df.select(cell(x).alias(x), cell(y).alias(y)).where(present(cell(x)) & present(cell(y)))
    return points.groupBy(cell(x), cell(y)).agg(F.count("*").alias("n"))


def finest_level(most: int) -> int:
    """The level up to which cells are looked at: some 4 to 16 times as many as may be returned."""
    return math.ceil(math.log2(most) / 2) + 2


def scatter_pyramid(df: DataFrame, x: str, y: str, most: int = 10_000) -> DataFrame:
    """A scatter plot of any number of points in at most ``most`` rows: ``level``, ``cell_x``, ``cell_y``, the cell's lower
    left corner ``x`` and ``y``, and ``n``, the exact number of points in it.

    Level k cuts the range of each measure into 2 ** k equal parts, so a cell is four of the next level. Returned are the
    cells that have points, of all levels from the coarsest on that fit into ``most`` together. Points without both values are not
    drawn; the last cell includes the right edge; a constant measure gets a range of one around its value.

    One pass for the ranges and one for the finest cells, which are counted map-side first and from which all others follow.
    """
    if most < 1:
        raise ValueError("at least one cell is returned")
    vx, vy, finest = cell(x).cast("double"), cell(y).cast("double"), finest_level(most)
    points = df.select(vx.alias("vx"), vy.alias("vy")).where(present(vx) & present(vy))
    ends = points.agg(F.min("vx"), F.max("vx"), F.min("vy"), F.max("vy")).first()
    across, up = Bins.over(x, ends[0], ends[1], 1 << finest), Bins.over(y, ends[2], ends[3], 1 << finest)
    cells = points.groupBy(across.bin_of(F.col("vx")).alias("cx"), up.bin_of(F.col("vy")).alias("cy")).agg(F.count("*").alias("n"))
    levels = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(finest))))
    shrink = F.expr(f"bigint(pow(2, {finest} - level))")
    every = levels.groupBy("level", F.floor(F.col("cx") / shrink).alias("cell_x"), F.floor(F.col("cy") / shrink).alias("cell_y")).agg(F.sum("n").alias("n"))
    # One row per level: how many cells there are up to it.
    upto = F.sum("some").over(Window.orderBy("level"))
    fit = every.groupBy("level").agg(F.count("*").alias("some")).withColumn("upto", upto).where(F.col("upto") <= most).select("level")
    edge = lambda bins, at: bins.edge(F.col(at) * shrink)
    return every.join(F.broadcast(fit), "level").select("level", "cell_x", "cell_y", edge(across, "cell_x").alias("x"), edge(up, "cell_y").alias("y"), "n")


@dataclass(frozen=True)
class Bins:
    """Equal-width bins between two finite values."""

    lo: float
    hi: float
    bins: int

    @classmethod
    def over(cls, column: str, least: float | None, most: float | None, bins: int) -> Bins:
        """A constant column gets a range of one around its value, an empty one that from 0 to 1."""
        lo, hi = (0.0, 1.0) if least is None else (least, most)
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        if not math.isfinite((hi - lo) / bins):
            raise ValueError(f"the range [{lo}, {hi}] of {column} is not finite")
        return cls(lo, hi, bins)

    @property
    def width(self) -> float:
        return (self.hi - self.lo) / self.bins

    def edge(self, i: Column) -> Column:
        return F.when(i == self.bins, F.lit(self.hi)).otherwise(i * F.lit(self.width) + F.lit(self.lo))

    def edges(self) -> list[float]:
        return [self.hi if i == self.bins else i * self.width + self.lo for i in range(self.bins + 1)]

    def bin_of(self, v: Column) -> Column:
        # The quotient can miss an edge by one rounding; the edges decide.
        guess = F.least(F.floor((v - self.lo) / self.width), F.lit(self.bins - 1))
        too_high = (v < self.edge(guess)).cast("bigint")
        too_low = ((v >= self.edge(guess + 1)) & (guess < self.bins - 1)).cast("bigint")
        return guess - too_high + too_low


def histogram_bins(df: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins over the range of the column; the last one includes its right edge.

    Bins without rows are kept. A constant column gets a range of one around its value, an
    empty one the range from 0 to 1; an infinite value leaves no range to cut.
    """
    v = F.col("v")
    values = df.select(cell(column).cast("double").alias("v")).where(present(v))
    scale = Bins.over(column, *values.agg(F.min(v), F.max(v)).first(), bins)
    counts = values.groupBy(scale.bin_of(v).alias("bin")).agg(F.count("*").alias("n"))
    bin_ = F.col("bin")
    every = df.sparkSession.range(0, bins, 1, 1).select(F.col("id").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin", scale.edge(bin_).alias("left_edge"), scale.edge(bin_ + 1).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


@dataclass(frozen=True)
class Box:
    """Quartiles of one measure and the fences its whiskers stay within."""

    measure: str
    n: int
    q1: float | None
    median: float | None
    q3: float | None
    least: float | None = None
    most: float | None = None

    @property
    def fences(self) -> tuple[Column, Column]:
        if not self.n:
            return F.lit(None).cast("double"), F.lit(None).cast("double")
        reach = (self.q3 - self.q1) * REACH
        return F.lit(self.q1 - reach), F.lit(self.q3 + reach)

    def beyond(self) -> Column:
        """Beyond a fence, and no NaN: Spark orders NaN after infinity. A scan takes it whole."""
        v = cell(self.measure).cast("double")
        low, high = self.fences
        return (v < low) | ((v > high) & (v <= float("inf")))


def boxes(df: DataFrame, measures: list[str] | tuple[str, ...], error: float | None = None) -> list[Box]:
    """The box of every measure, one small object each. With a rank ``error`` the quartiles come from sketches, in one pass."""
    found = exact_quantiles(df, measures, QUARTILES) if error is None else approximate_quantiles(df, measures, QUARTILES, error)
    return [Box(m, found[m].n, *found[m].values, found[m].least, found[m].most) for m in measures]


def box_stats(df: DataFrame, measures: list[str] | tuple[str, ...], known: list[Box] | None = None, *, error: float | None = None) -> DataFrame:
    """Per measure: rows, quartiles, whiskers at the last value within reach, outliers beyond. With a rank ``error``
    the quartiles are approximate; whiskers and outliers are exact for these quartiles."""
    known = boxes(df, measures, error) if known is None else known
    columns = [_box_struct(box).alias(f"box{i}") for i, box in enumerate(known)]
    return df.agg(*columns).select(F.inline(F.array(*[f"box{i}" for i in range(len(columns))])))


def _box_struct(box: Box) -> Column:
    v = cell(box.measure).cast("double")
    low, high = box.fences
    q1, median, q3 = (F.lit(q).cast("double") for q in (box.q1, box.median, box.q3))
    return F.struct(
        F.lit(box.measure).alias("measure"),
        F.lit(box.n).cast("bigint").alias("n"),
        q1.alias("q1"), median.alias("median"), q3.alias("q3"),
        # A whisker never ends inside the box.
        F.least(F.min(F.when(present(v) & (v >= low), v)), q1).alias("whisker_low"),
        F.greatest(F.max(F.when(present(v) & (v <= high), v)), q3).alias("whisker_high"),
        F.count_if(box.beyond()).alias("outliers"),
    )


def box_outliers(df: DataFrame, measures: list[str] | tuple[str, ...], known: list[Box] | None = None, *, error: float | None = None) -> DataFrame:
    """Distinct values beyond the whiskers per measure and how often each occurs."""
    known = boxes(df, measures, error) if known is None else known
    outside = F.lit(False)
    for box in known:
        outside = outside | box.beyond()
    # One constant condition first: it reaches the scan, and few rows are left to unpivot.
    rows = df.where(outside).select(
        *[F.when(box.beyond(), cell(box.measure).cast("double")).alias(box.measure) for box in known]
    )
    return (
        rows.unpivot([], [cell(box.measure) for box in known], "measure", "value")
        .where(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count("*").alias("n"))
    )


CHARTS = "chart string, series string, item string, x double, y double, n bigint"


def chart_table(df: DataFrame, x: str, y: str, histogram: str, measures: list[str] | tuple[str, ...], bins: int = BINS, *,
                span: tuple[float | None, float | None] | None = None) -> DataFrame:
    """All charts of a table in one long frame ``(chart, series, item, x, y, n)``.

    Reads the table once for the quartiles (up to twice more for measures with many digits, then
    only their open spans), once for whiskers and bins together, and once each for points and
    outliers when the result is used. The bins' range is ``span`` where it is known, else it comes with the
    quartiles.
    """
    known = {box.measure: box for box in boxes(df, list(dict.fromkeys([*measures, *([] if span else [histogram])])))}
    scale = Bins.over(histogram, *(span or (known[histogram].least, known[histogram].most)), bins)
    v = cell(histogram).cast("double")
    at = scale.bin_of(v)
    # One row of a size that only the numbers of measures and bins decide.
    found = df.agg(F.array(*[_box_struct(known[m]) for m in measures]).alias("boxes"),
                   F.array(*[F.count_if(present(v) & (at == i)) for i in range(bins)]).alias("bins")).first()
    edges = scale.edges()
    small = [("histogram", histogram, "bin", left, right, n) for left, right, n in zip(edges, edges[1:], found["bins"])]
    small += [("box", b["measure"], item, None, b[item], b["n"]) for b in found["boxes"] for item in ("q1", "median", "q3", "whisker_low", "whisker_high")]

    def part(frame: DataFrame, chart: str, series: Column, item: str, x: Column, y: Column) -> DataFrame:
        return frame.select(F.lit(chart).alias("chart"), series.alias("series"), F.lit(item).alias("item"),
                            x.cast("double").alias("x"), y.cast("double").alias("y"), "n")

    points = part(scatter_points(df, x, y), "scatter", F.lit(f"{x}|{y}"), "point", cell(x), cell(y))
    beyond = part(box_outliers(df, measures, [known[m] for m in measures]), "box", F.col("measure"), "outlier", F.lit(None), F.col("value"))
    return points.unionByName(df.sparkSession.createDataFrame(small, CHARTS)).unionByName(beyond)
