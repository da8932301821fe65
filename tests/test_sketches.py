"""Quantiles from sketches: their error, and that parts merge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sealframe.operators.charts import box_stats
from sealframe.operators.ranks import exact_quantiles
from sealframe.operators.sketches import approximate_quantiles, merge_sketches, rank_errors, size_for, sketch_measures, sketch_quantiles
from sealframe.session import shared_folder

CHANCES = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def error_of(values, p, q):
    """By hand: the distance of p to the ranks that q has among the values."""
    return max(0.0, sum(v < q for v in values) / len(values) - p, p - sum(v <= q for v in values) / len(values))


@pytest.fixture(scope="module")
def measured(spark):
    """Heavy ties, a long tail, sorted values, and one value in a third of all rows; spread over parts."""
    draw = random.Random(3)
    values = [(float(draw.randrange(5)), draw.paretovariate(0.5), float(i), 7.0 if i % 3 else draw.gauss(0, 1), None if i % 2 else math.nan, f"g{min(3, i % 11)}") for i in range(20_000)]
    frame = spark.createDataFrame(values, "ties double, tail double, `a.b` double, hot double, none double, g string").repartition(7)
    return values, frame.cache()


@pytest.mark.parametrize("error", [0.1, 0.01, 0.002])
def test_error_is_kept(measured, error):
    values, frame = measured
    names = ["ties", "tail", "a.b", "hot"]
    found = approximate_quantiles(frame, names, CHANCES, error)
    for i, name in enumerate(names):
        column = [v[i] for v in values]
        assert (found[name].n, found[name].least, found[name].most) == (len(column), min(column), max(column))
        assert (found[name].values[0], found[name].values[-1]) == (min(column), max(column))
        for p, q in zip(CHANCES, found[name].values):
            assert q in column and error_of(column, p, q) <= error
    empty = approximate_quantiles(frame, ["none"], CHANCES, error)["none"]
    assert (empty.n, set(empty.values), empty.least) == (0, {None}, None)


def test_stored_parts_merge(spark, measured):
    """Sketches of each group are stored; those of all rows come from them alone."""
    values, frame = measured
    path = f"{shared_folder(spark)}/sketches"
    sketch_measures(frame, ["tail", "hot", "none"], 0.01, by=["g"]).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.count() == 12 and stored.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    merged = {r.measure: r for r in sketch_quantiles(merge_sketches(stored), CHANCES).collect()}
    for i, name in ((1, "tail"), (3, "hot")):
        column = [v[i] for v in values]
        assert merged[name].n == len(column)
        assert all(error_of(column, p, q) <= 0.01 for p, q in zip(CHANCES, merged[name]["values"]))
    assert merged["none"]["values"] is None and merged["none"].n == 0
    groups = {(r.g, r.measure): r["values"] for r in sketch_quantiles(merge_sketches(stored, ["g"]), [0.5]).collect()}
    tail = [v[1] for v in values if v[5] == "g1"]
    assert error_of(tail, 0.5, groups["g1", "tail"][0]) <= 0.01


def test_measured_errors(measured):
    values, frame = measured
    quantiles = sketch_quantiles(sketch_measures(frame, ["tail", "none"], 0.05), CHANCES)
    rows = rank_errors(frame, quantiles, CHANCES).collect()
    assert len(rows) == len(CHANCES)
    column = [v[1] for v in values]
    for r in rows:
        assert r.error == pytest.approx(error_of(column, r.probability, r.value)) and r.error <= 0.05
    assert rank_errors(frame, quantiles.where("measure = 'none'"), CHANCES).count() == 0


def test_one_pass_makes_all_sketches(measured):
    _, frame = measured
    plan = sketch_measures(frame, ["ties", "tail"], by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1 and "Expand" not in plan and "Generate explode" not in plan


def test_boxes_from_sketches(measured):
    _, frame = measured
    exact = {r.measure: r for r in box_stats(frame, ["a.b", "ties"]).collect()}
    near = {r.measure: r for r in box_stats(frame, ["a.b", "ties"], error=0.01).collect()}
    assert near["ties"] == exact["ties"]
    for column in ("q1", "median", "q3"):
        assert abs(near["a.b"][column] - exact["a.b"][column]) <= 0.01 * 20_000 + 1
    assert (near["a.b"].whisker_low, near["a.b"].whisker_high, near["a.b"].outliers) == (0.0, 19_999.0, 0)
    assert exact_quantiles(frame, ["ties"], [0.5])["ties"].values == (2.0,)


def test_errors_that_cannot_be_had():
    for bad in (0, 1, -0.1, 1e-7):
        with pytest.raises(ValueError):
            size_for(bad)
    assert size_for(0.9) >= 8 and size_for(0.01) < size_for(0.001)
