"""Chart statistics against numpy."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealframe.operators.charts import Bins, box_outliers, box_stats, finest_level, histogram_bins, scatter_points, scatter_pyramid
from sealframe.operators.ranks import exact_quantiles

rng = np.random.default_rng(11)

SHAPES = {
    "one value": np.array([3.5]),
    "two values": np.array([1.0, 2.0]),
    "constant": np.full(50, 7.25),
    "few digits": np.round(rng.normal(5, 1, 900), 1),
    "continuous": rng.normal(0, 1e6, 2000),
    "one value holds most rows": np.concatenate([np.full(1500, 42.0), rng.uniform(0, 100, 700)]),
    "all in one slot": 1.7e9 + rng.uniform(0, 1e-3, 1500),
    "neighbouring doubles": np.nextafter(1.0, 2.0) * (1 + np.arange(400) * 2.0**-52),
    "both signs and zero": np.concatenate([-rng.exponential(1e-3, 300), [0.0, -0.0], rng.exponential(1e3, 300)]),
    "tiny": rng.uniform(-1e-300, 1e-300, 500),
    "tiny, log-uniform": 10.0 ** rng.uniform(-293, -13, 3000),
    "subnormal": rng.integers(-10**6, 10**6, 2000) * 5e-324,
    "huge, log-uniform": 10.0 ** rng.uniform(20, 290, 2000) * rng.choice([-1.0, 1.0], 2000),
    "huge": rng.uniform(-1e300, 1e300, 500),
    "far outliers": np.concatenate([rng.normal(10, 1, 500), [1e12, -1e12, 500.0]]),
}


def frame_of(spark, values, name="x"):
    return spark.createDataFrame([(float(v),) for v in values], f"`{name}` double").repartition(3)


@pytest.mark.parametrize("shape", SHAPES)
def test_quantiles(spark, shape):
    probabilities = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    found = exact_quantiles(frame_of(spark, SHAPES[shape]), ["x"], probabilities)["x"]
    assert found.n == len(SHAPES[shape])
    # numpy stores 0.9 * (n - 1) the same way; the interpolation may differ by one rounding.
    np.testing.assert_allclose(found.values, np.percentile(SHAPES[shape], [100 * p for p in probabilities]), rtol=1e-15)


def test_quantiles_next_to_infinities(spark):
    values = [float("-inf")] * 2 + [1.0, 2.0, 4.0] + [float("inf")] * 2
    found = exact_quantiles(frame_of(spark, values), ["x"], (0.0, 0.5, 0.625, 1.0))["x"]
    assert found.values == (float("-inf"), 2.0, 3.5, float("inf"))


def test_every_pass_narrows_to_its_bound(spark, monkeypatch):
    """What the last pass orders is what one part of one slot holds, whatever the magnitudes."""
    from sealframe.operators import ranks

    seen = []
    plain = ranks._finer_pass
    monkeypatch.setattr(ranks, "_finer_pass", lambda df, picks, cut: seen.append([(p.lo, p.hi) for p in picks]) or plain(df, picks, cut))
    values = np.concatenate([SHAPES["tiny, log-uniform"], SHAPES["subnormal"], SHAPES["huge, log-uniform"], SHAPES["continuous"]])
    ranks.exact_quantiles(frame_of(spark, values), ["x"], (0.1, 0.25, 0.5, 0.75, 0.9))
    for number, spans in enumerate(seen):
        for lo, hi in spans:
            doubles = abs(int(np.float64(hi).view(np.int64)) - int(np.float64(lo).view(np.int64)))
            assert doubles <= (2 ** 44, 2 ** 24)[number]


def test_charts_read_the_table_a_stated_number_of_times(spark, tmp_path):
    from sealframe.operators.charts import chart_table

    path = str(tmp_path / "values")
    spark.createDataFrame([(float(i % 7), float(i % 5)) for i in range(500)], "a double, b double").write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    frame = spark.read.parquet(path).coalesce(1).mapInArrow(counted, "a double, b double")
    chart_table(frame, "a", "b", "a", ["a", "b"]).collect()
    assert reads.value == 4  # few digits: quartiles, whiskers with bins, points, outliers


def test_outlier_condition_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "values")
    frame_of(spark, SHAPES["far outliers"]).write.parquet(path)
    plan = box_outliers(spark.read.parquet(path), ["x"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(x," in plan


def box_of(values):
    """The documented rules of box plots, in numpy."""
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    reach = 1.5 * (q3 - q1)
    low, high = values[values >= q1 - reach], values[values <= q3 + reach]
    whisker_low, whisker_high = min(low.min(), q1), max(high.max(), q3)
    outside = values[(values < whisker_low) | (values > whisker_high)]
    return q1, median, q3, whisker_low, whisker_high, outside


@pytest.mark.parametrize("shape", [s for s in SHAPES if not s.startswith("huge")])
def test_boxes(spark, shape):
    values = SHAPES[shape]
    *stats, outside = box_of(values)
    frame = frame_of(spark, values)
    row = box_stats(frame, ["x"]).first()
    np.testing.assert_allclose([row.q1, row.median, row.q3, row.whisker_low, row.whisker_high], stats, rtol=1e-15)
    assert (row.n, row.outliers) == (len(values), len(outside))
    got = sorted(v for r in box_outliers(frame, ["x"]).collect() for v in [r.value] * r.n)
    assert got == sorted(outside.tolist())


def test_boxes_of_several_measures_skip_missing_values(spark):
    frame = spark.createDataFrame(
        [(1.0, None, 5.0), (2.0, None, float("nan")), (None, None, 7.0), (100.0, None, 9.0)], "a double, b double, c double")
    a, b, c = box_stats(frame, ["a", "b", "c"]).collect()
    assert (a.n, a.median, b.n, b.median, b.whisker_low, c.n, c.median) == (3, 2.0, 0, None, None, 3, 7.0)
    assert box_outliers(frame, ["b"]).count() == 0


def test_points_are_counted_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).cast("double").alias("x"), F.lit(1.0).alias("y"))
    plan = scatter_points(frame, "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")


@pytest.mark.parametrize("shape", [s for s in SHAPES if s not in ("neighbouring doubles", "subnormal") and not s.startswith("huge")])
def test_histogram(spark, shape, bins=10):
    counts, edges = np.histogram(SHAPES[shape], bins)
    rows = histogram_bins(frame_of(spark, SHAPES[shape]), "x", bins).orderBy("bin").collect()
    assert [r.bin for r in rows] == list(range(bins))
    assert [r.left_edge for r in rows] == edges[:-1].tolist()
    assert [r.right_edge for r in rows] == edges[1:].tolist()
    assert [r.n for r in rows] == counts.tolist()


@pytest.mark.parametrize("bins", [1, 37, 1000])
def test_histogram_with_other_numbers_of_bins(spark, bins):
    test_histogram(spark, "continuous", bins)


def test_histogram_values_on_edges(spark):
    values = np.concatenate([np.round(np.arange(0, 101) * 0.01, 2)] * 3)
    rows = histogram_bins(frame_of(spark, values), "x").orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram(values, 10)[0].tolist()


def test_histogram_without_values(spark):
    frame = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    rows = histogram_bins(frame, "x").orderBy("bin").collect()
    assert sum(r.n for r in rows) == 0
    assert (rows[0].left_edge, rows[-1].right_edge) == (0.0, 1.0)


def test_histogram_needs_a_finite_range(spark):
    with pytest.raises(ValueError, match="not finite"):
        histogram_bins(frame_of(spark, [1.0, float("inf")]), "x")


def test_scatter_counts_overplotted_points(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, None), (float("nan"), 1.0), (4.0, 5.0)], "x double, y double")
    assert sorted(tuple(r) for r in scatter_points(frame, "x", "y").collect()) == [(1.0, 2.0, 2), (4.0, 5.0, 1)]


def plain_pyramid(points, most):
    """Every point's cell at every level, by its own range of edges."""
    points = [(x, y) for x, y in points if None not in (x, y) and x == x and y == y]
    finest = finest_level(most)
    scales = [Bins.over("v", min(v, default=None), max(v, default=None), 1 << finest) for v in ([p[0] for p in points], [p[1] for p in points])]

    def at(scale, v):
        return max(i for i in range(scale.bins) if v >= scale.edges()[i])

    finest_cells = [tuple(at(s, v) for s, v in zip(scales, p)) for p in points]
    out, total = [], 0
    for level in range(finest + 1):
        size = 1 << (finest - level)
        cells = collections.Counter((cx // size, cy // size) for cx, cy in finest_cells)
        total += len(cells)
        if total > most:
            break
        out += [(level, cx, cy, scales[0].edges()[cx * size], scales[1].edges()[cy * size], n) for (cx, cy), n in cells.items()]
    return sorted(out)


@pytest.mark.parametrize("most", [1, 7, 60, 400])
@pytest.mark.parametrize("kind", ["spread", "line", "hot", "constant", "one", "none"])
def test_pyramid(spark, most, kind):
    draw = random.Random(most)
    points = {
        "spread": [(draw.uniform(-1, 1), draw.uniform(0, 1000)) for _ in range(300)] + [(None, 1.0), (1.0, None), (math.nan, 2.0), (0.0, math.nan)],
        "line": [(i / 10, i * 3.0) for i in range(101)],
        "hot": [(0.1, 0.2)] * 200 + [(draw.gauss(0, 1), draw.gauss(0, 1)) for _ in range(100)],
        "constant": [(5.0, float(i)) for i in range(9)],
        "one": [(2.0, 3.0)],
        "none": [(None, None)],
    }[kind]
    frame = spark.createDataFrame(points, "`a.b` double, y double").repartition(3)
    got = sorted(map(tuple, scatter_pyramid(frame, "a.b", "y", most).collect()))
    assert got == plain_pyramid(points, most) and len(got) <= most
    for level in {r[0] for r in got}:
        assert sum(r[5] for r in got if r[0] == level) == len([p for p in points if None not in p and p[0] == p[0] and p[1] == p[1]])


def test_pyramid_needs_room(spark):
    with pytest.raises(ValueError):
        scatter_pyramid(spark.range(1).selectExpr("1.0 x", "2.0 y"), "x", "y", 0)
