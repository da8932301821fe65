"""Quantiles within a stated rank error, from sketches that are made in one pass, stored and merged.

The exact quantiles of ``ranks`` read a table up to three times. A sketch reads it once, whatever the values, takes some
KB for each measure and group, and merges with those of other days or parts of a table, so none of these is read again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from sealframe.functions.text import cell
from sealframe.operators.ranks import Quantiles, present

# A KLL sketch of size k has a rank error of at most C / k ** E with 99 % confidence, and its smallest and
# largest k.
C, E = 2.296, 0.9723
LEAST_K, MOST_K = 8, 65_535


def size_for(error: float) -> int:
    """The size of a sketch whose rank error is ``error`` at twice the 99 % bound, which one in some millions misses."""
    least = 2 * C / MOST_K ** E
    if not least <= error < 1:
        raise ValueError(f"a rank error must be below 1 and at least {least:.6f}")
    return max(LEAST_K, math.ceil((2 * C / error) ** (1 / E)))


def sketch_measures(df: DataFrame, measures: list[str] | tuple[str, ...], error: float = 0.01, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """A sketch of each measure, for each group: the columns of ``by``, measure, n, least, most and sketch. Null and NaN do not count.

    One pass. Sketches are made map-side, so a group that makes up a third of all rows sends one for each task.
    """
    size = F.lit(size_for(error))
    made = [F.struct(F.lit(m).alias("measure"), F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"),
                     F.kll_sketch_agg_double(v, size).alias("sketch")) for m in measures for v in [_value(m)]]
    names = [f"__sketch{i}" for i in range(len(made))]
    groups = df.groupBy(*map(cell, by)) if by else df.groupBy()
    return groups.agg(*[s.alias(n) for s, n in zip(made, names)]).select(*map(cell, by), F.inline(F.array(*names)))


def _value(measure: str) -> Column:
    v = cell(measure).cast("double")
    return F.when(present(v), v)


def merge_sketches(sketches: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Sketches of groups, days or parts as those of fewer groups; their error stays. Sketches of one size only merge without loss."""
    return sketches.groupBy(*map(cell, by), "measure").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: list[float] | tuple[float, ...]) -> DataFrame:
    """The sketches' columns but for the sketch, and ``values``: one of the rows' own values for each probability, none without rows.

    The share of rows up to a value is the probability, give or take the error. 0 and 1 give the exact least and most."""
    asked = [F.lit(float(p)) for p in probabilities]
    values = [F.col("least") if p == 0 else F.col("most") if p == 1 else F.kll_sketch_get_quantile_double("sketch", a) for p, a in zip(probabilities, asked)]
    return sketches.withColumn("values", F.when(F.col("n") > 0, F.array(*values))).drop("sketch")


def approximate_quantiles(df: DataFrame, measures: list[str] | tuple[str, ...], probabilities: list[float] | tuple[float, ...], error: float = 0.01) -> dict[str, Quantiles]:
    """What ``exact_quantiles`` gives, within a rank error and from one pass. Runs when called; a row for each measure comes to the driver."""
    rows = sketch_quantiles(sketch_measures(df, measures, error), probabilities).collect()
    return {r.measure: Quantiles(r.n, tuple(r["values"] or [None] * len(probabilities)), r.least, r.most) for r in rows}


def rank_errors(df: DataFrame, quantiles: DataFrame, probabilities: list[float] | tuple[float, ...]) -> DataFrame:
    """measure, probability, value and ``error`` of quantiles of a whole table: how far the probability is from the ranks that rows of that
    value really have. One more pass; the values, one row for each measure, come to the driver first."""
    found = {r.measure: r for r in quantiles.collect()}
    asked = [(m, p, v) for m, r in found.items() for p, v in zip(probabilities, r["values"] or ())]
    below = [F.count_if(_value(m) < v).alias(f"below{i}") for i, (m, _, v) in enumerate(asked)]
    upto = [F.count_if(_value(m) <= v).alias(f"upto{i}") for i, (m, _, v) in enumerate(asked)]
    if not asked:
        return df.sparkSession.createDataFrame([], "measure string, probability double, value double, n bigint, error double")
    totals = df.agg(*below, *upto)
    rows = [F.struct(F.lit(m).alias("measure"), F.lit(float(p)).alias("probability"), F.lit(v).alias("value"), F.lit(found[m].n).cast("bigint").alias("n"),
                     F.greatest(F.lit(0.0), F.col(f"below{i}") / found[m].n - p, p - F.col(f"upto{i}") / found[m].n).alias("error")) for i, (m, p, v) in enumerate(asked)]
    return totals.select(F.inline(F.array(*rows)))
