"""Connected components of links, in rounds of aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sealframe.llm.shared import kept


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every node of ``links`` (a, b).

    Alternates two steps until nothing changes: every node tells its larger neighbours, then its
    smaller ones, the smallest node it knows. The number of links never grows, stars stay as they are,
    and long chains take a number of rounds that grows with the logarithm of their length. Each round
    is written to the shared folder, or below ``folder``. A node's neighbours are only ever aggregated, so a hub does no harm.
    """
    edges = kept(_both(links.where("a <> b")).where("a > b").distinct(), folder)
    state = _state(edges)
    while state[0]:
        edges = kept(_small(_large(edges)), folder)
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    told = edges.join(least, "a")
    return told.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return row["n"], int(row["s"])
