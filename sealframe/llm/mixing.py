"""Mixing sources to target weights by Poisson replication.

A document of a source is repeated a Poisson number of times whose mean is the source's target rate.
The number comes from inverting the distribution at a uniform hash of the document and a seed, so
it is the same in every run and on every partitioning. The copies are then put in a random order
over the whole output.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# Uniform numbers are 13 hex digits of a hash.
DIGITS = 13
# Up to this rate the distribution is summed from 0, above it around its mean.
DIRECT = 500.0
# The highest rate for an output size that the caller names.
MAX_RATE = 1e6
# Copies of a row that are made at one place where a source has a high rate.
BLOCK = 1024


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the MD5 of a text."""
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def thresholds(rate: float) -> list[float]:
    """P(at most k) for k = 0, 1, ... until it leaves no room below 1 for a uniform number."""
    term = total = math.exp(-rate)
    found, k = [total], 0
    while total < 1 - 16.0 ** -DIGITS and (k < rate or term > 0) and k < 4 * rate + 100:
        k += 1
        term *= rate / k
        total += term
        found.append(total)
    return found


def steps_around(rate: float) -> tuple[int, list[float]]:
    """A number k and P(at most k), P(at most k + 1), ... for a rate above ``DIRECT``, over twelve standard
    deviations and more on both sides of the mean; what lies beyond is below any uniform number's step."""
    mode = int(rate)
    width = min(mode, int(12 * math.sqrt(rate)) + 50)
    up = np.cumprod(rate / np.arange(mode + 1, mode + width + 1))
    down = np.cumprod((mode - np.arange(width)) / rate)
    total = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return mode - width, (total / total[-1]).tolist()


def rates(docs: DataFrame, weights: dict[str, float], size: Column, total: float | None = None) -> dict[str | None, float]:
    """Mean repetitions per source: target share of the output over the size that the source has.

    ``weights`` name the target shares of some sources; what they leave of 1 goes to all the other
    rows together (key None), null sources too. ``total`` is the wanted output in units of ``size``,
    by default that of the input. Sizes are summed map-side; one row per named source and one for the
    rest come to the driver. A share whose rows have no size cannot be met and is left out. Any rate
    is met for the input's own size; a ``total`` for which a rate is above ``MAX_RATE`` raises.
    """
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares of 1")
    group = _group(weights)
    sizes = {r["g"]: float(r["n"]) for r in docs.groupBy(group.alias("g")).agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).collect()}
    whole = sum(sizes.values()) if total is None else total
    share = {**weights, None: max(0.0, 1 - sum(weights.values()))}
    found = {s: share[s] * whole / n if n > 0 else 0.0 for s, n in sizes.items()}
    if total is not None and any(r > MAX_RATE for r in found.values()):
        raise ValueError(f"a source would have to be repeated more than {MAX_RATE:g} times")
    return found


def _group(weights: dict[str, float]) -> Column:
    return F.when(F.col("source").isin(*weights), F.col("source")) if weights else F.lit(None).cast("string")


def copies(rate: dict[str | None, float], seed: int, weights: dict[str, float]) -> Column:
    """How often a document is taken: the number of thresholds at or below its uniform number."""
    # A null id takes the text's hash, so that such documents do not all draw the same number.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce("text", F.lit("")))))
    u = uniform(F.concat(F.lit(f"{seed}:"), name))
    steps, before = F.lit(None).cast("array<double>"), F.lit(0)
    for source, r in rate.items():
        mine = _group(weights).eqNullSafe(F.lit(source))
        if r > DIRECT:
            first, some = steps_around(r)
            # One literal, however many numbers it has.
            numbers = F.split(F.lit(",".join(map(repr, some))), ",").cast("array<double>")
            before = F.when(mine, F.lit(first)).otherwise(before)
        else:
            numbers = F.array(*map(F.lit, thresholds(r)))
        steps = F.when(mine, numbers).otherwise(steps)
    return before + F.size(F.filter(steps, lambda p: p <= u))


def mix(docs: DataFrame, weights: dict[str, float], seed: int = 17, total: float | None = None, copy: str = "copy", place: str = "place") -> DataFrame:
    """``docs`` (with doc_id, text, source) replicated to the target weights, in a global random order.

    Adds the columns ``copy`` (from 0) and ``place``, the random number by which the output is ordered
    inside its partitions; partitions are themselves a hash of it. Sizes count characters, one more per
    document so that empty texts can be drawn too. Repeated rows with the same id draw the same
    count. Columns of the two names are replaced. Empty input gives an empty result.
    """
    docs = docs.drop(copy, place)
    size = (F.coalesce(F.length("text"), F.lit(0)) + 1).cast("double")
    rate = rates(docs, weights, size, total)
    # The input has no row where no source has a rate.
    times = copies(rate, seed, weights) if rate else F.lit(0)
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))

    def repeated(rows: DataFrame) -> DataFrame:
        return rows.withColumn(copy, times).where(F.col(copy) > 0)

    one = F.explode(F.sequence(F.lit(0), F.col(copy) - 1))
    high = [s for s, r in rate.items() if r > DIRECT]
    if high:
        # Few rows make many copies: their blocks are dealt out before the copies are made.
        is_high = F.lit(False)
        for s in high:
            is_high = is_high | _group(weights).eqNullSafe(F.lit(s))
        blocks = repeated(docs.where(is_high)).withColumn(place, F.explode(F.sequence(F.lit(0), F.col(copy) - 1, F.lit(BLOCK)))).repartition(F.col(place), name)
        many = blocks.withColumn(copy, F.explode(F.sequence(F.col(place), F.least(F.col(place) + BLOCK, F.col(copy)) - 1))).drop(place)
        taken = repeated(docs.where(~is_high)).withColumn(copy, one).unionByName(many)
    else:
        taken = repeated(docs).withColumn(copy, one)
    key = F.concat_ws(":", F.lit(f"{seed}s"), name, F.col(copy).cast("string"))
    return taken.withColumn(place, uniform(key)).repartition(place).sortWithinPartitions(place)
