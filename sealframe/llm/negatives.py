"""Hard negatives: for each anchor's nearest rows of its label, rows of other labels that score a bit less.

Scores are exact integer inner products. Anchors and candidates are dealt into tiles of bounded size; a (candidate tile,
anchor tile) pair is one group, whose product comes from Strassen's recursion on integers. Of each product only small
heaps go on: an anchor's best rows of its own label in a first round, in a second one the best rows in the window of
scores below each of these. Heaps of all tiles merge in a ranking that drops beyond its limit before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sealframe.llm.shared import kept
from sealframe.session import staging_folder

# Bytes of a tile's numbers, about; anchors that are multiplied with a tile at once; and the length of a product's shortest
# side from which it is cut into quarters.
TILE, STRIP, LEAF = 16 << 20, 256, 16
INTEGER = 1 << 63


@dataclass(frozen=True)
class Mining:
    """``positives`` of an anchor, and ``negatives`` of a positive with ``low`` % <= negative / positive score <= ``high`` %."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: float = 256.0

    def window(self, positive: int) -> tuple[int, int]:
        """The least and the largest score of a negative; none where the first is larger."""
        return -(-self.low * positive // 100), self.high * positive // 100


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of integer matrices by seven products of quarters each, zeros added where a side is odd.

    The sums are those of the ring of 64-bit integers, so the result is exact wherever it fits, whatever the steps in
    between were. Matrices of Python integers work too.
    """
    n, d, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, d, m) <= leaf:
        return a @ b if min(n, d, m) else np.zeros((n, m), a.dtype)
    n2, d2, m2 = (-(-x // 2) for x in (n, d, m))
    a, b = _padded(a, 2 * n2, 2 * d2), _padded(b, 2 * d2, 2 * m2)
    a11, a12, a21, a22 = a[:n2, :d2], a[:n2, d2:], a[n2:, :d2], a[n2:, d2:]
    b11, b12, b21, b22 = b[:d2, :m2], b[:d2, m2:], b[d2:, :m2], b[d2:, m2:]
    out = np.empty((2 * n2, 2 * m2), a.dtype)
    # Each product goes where it belongs at once, so that only one is held.
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:n2, :m2], out[n2:, m2:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    out[n2:, :m2] = p
    out[n2:, m2:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:n2, m2:] = p
    out[n2:, m2:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:n2, :m2] += p
    out[n2:, :m2] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:n2, :m2] -= p
    out[:n2, m2:] += p
    out[n2:, m2:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:n2, :m2] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:n, :m]


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), x.dtype)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def integers(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python integers where one does not fit."""
    whole = np.floor(values.astype(float) * scale)
    if not whole.size or np.abs(whole).max() < 1 << 62:
        return whole.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(whole)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of a and b. Where 64 bits might not hold one, of Python integers."""
    largest = [int(np.abs(x).max(initial=0)) if x.dtype != object else max(map(abs, x.ravel().tolist()), default=0) for x in (a, b)]
    if a.dtype == object or b.dtype == object or a.shape[1] * largest[0] * largest[1] >= INTEGER:
        a, b = a.astype(object), b.astype(object)
    return strassen(a, b.T)


class Heaps:
    """The best ``k`` (score, id, row) of each of ``n`` owners: highest scores, then smallest ids, then smallest rows."""

    def __init__(self, n: int, k: int):
        self.k, self.kept = k, [np.zeros((0, 3), object) for _ in range(n)]

    def push(self, owner: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if scores.dtype == object:
            return self.merge(owner, np.stack([scores, ids.astype(object), rows.astype(object)], axis=1))
        if len(scores) > self.k:
            # All that reach the k-th score, ties included.
            at = np.flatnonzero(scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k])
            scores, ids, rows = scores[at], ids[at], rows[at]
        order = np.lexsort((rows, ids, -scores))[:self.k]
        self.merge(owner, np.stack([scores[order].astype(object), ids[order].astype(object), rows[order].astype(object)], axis=1))

    def merge(self, owner: int, other: np.ndarray) -> None:
        """Another heap of the same owner."""
        both = [*self.kept[owner].tolist(), *other.tolist()]
        both.sort(key=lambda x: (-x[0], x[1], x[2]))
        self.kept[owner] = np.array(both[:self.k], object).reshape(-1, 3)


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and v (doubles) of rows that have all of them, every component finite."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), x.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite)


FOUND = "anchor bigint, slot int, score bigint, vec_id bigint, row bigint"


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], label: Column | None = None, rules: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank from 1, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, embedding and label; ``label`` is an expression that takes the label's place, ``is_anchor`` a
    condition on the id. Rows without an id, a label or a vector, or with a null or non-finite component, take no part. Higher
    scores come first, then smaller ids. Every row counts for itself: one that repeats an anchor is another row of its
    label. Vectors of different lengths do not meet; empty ones have the score 0. A positive without a negative has no
    row. Scores are exact; one beyond 64 bits that would be returned fails the query.

    ``vectors`` is written once with a number for each row; both rounds read that table.
    """
    spark = vectors.sparkSession
    with staging_folder(spark) as folder:
        rows = kept(usable(vectors, F.col("label") if label is None else label).withColumn("row", F.monotonically_increasing_id())
                    .withColumn("size", F.size("v")).withColumn("mix", F.xxhash64("row")), folder)
        # One row per length of vectors.
        sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor(F.col("vec_id"))).alias("m"))
        each = F.greatest(F.lit(1), F.floor(TILE / 8 / F.greatest("size", F.lit(1))))
        split = kept(sizes.where("m > 0").select("size", F.ceil(F.col("n") / each).cast("int").alias("tiles"), F.ceil(F.col("m") / each).cast("int").alias("blocks")), folder)
        dealt = rows.join(split, "size")
        tile, block = F.pmod("mix", F.col("tiles")).cast("int"), F.pmod(F.shiftright("mix", 24), F.col("blocks")).cast("int")
        candidates = dealt.select("size", tile.alias("tile"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "label", "row", "v")
        anchors = dealt.where(is_anchor(F.col("vec_id"))).select("size", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), block.alias("block"),
                                                                 "vec_id", "label", "row", "v")
        none = F.lit(None).cast("array<bigint>")
        positives = kept(_best(_tiles(candidates, anchors.withColumn("scores", none), rules), rules.positives), folder)
        scores = positives.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("scores"))
        second = anchors.join(scores.withColumnRenamed("anchor", "row"), "row")
        negatives = _best(_tiles(candidates, second, rules), rules.negatives)
        of = positives.select("anchor", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        ids = rows.where(is_anchor(F.col("vec_id"))).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        result = negatives.join(of, ["anchor", "slot"]).join(ids, "anchor").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        return kept(result)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The heaps of all tiles as one: ``rank`` from 1 to k per (anchor, slot)."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def _tiles(candidates: DataFrame, anchors: DataFrame, rules: Mining) -> DataFrame:
    """The heaps of every pair of tiles. Where anchors have no ``scores`` yet, their best rows of the same label (slot 0); else
    the best rows of other labels in the window of each score (slots from 1)."""
    keys, strip = ["size", "tile", "block"], STRIP

    def matrix(table: pa.Table, name: str, size: int) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, size)

    def group(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [x for x in _heaps(left, right, key[0].as_py(), matrix, rules, strip)] if left.num_rows and right.num_rows else []
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["anchor", "slot", "score", "vec_id", "row"])

    # Names of their own, as both sides come from the same table.
    right = anchors.select(*[F.col(c).alias(f"a_{c}") for c in (*keys, "vec_id", "label", "row", "v", "scores")])
    return candidates.groupBy(*keys).cogroup(right.groupBy(*[f"a_{c}" for c in keys])).applyInArrow(group, FOUND)


def _heaps(left: pa.Table, right: pa.Table, size: int, matrix: Callable, rules: Mining, strip: int) -> Iterator[tuple[int, int, int, int, int]]:
    labels, ids, rows = (left.column(c).to_numpy() for c in ("label", "vec_id", "row"))
    own, anchor = right.column("a_label").to_numpy(), right.column("a_row").to_numpy()
    points, queries = integers(matrix(left, "v", size), rules.scale), integers(matrix(right, "a_v", size), rules.scale)
    known = right.column("a_scores").to_pylist()
    if known[0] is None:
        # Only rows of the same label are of use: a product for each label of the anchors.
        heaps = Heaps(len(own), rules.positives)
        for label in np.unique(own):
            other = np.flatnonzero(labels == label)
            for mine, scores in _strips(queries, np.flatnonzero(own == label), points[other], strip):
                for a, line in zip(mine, scores):
                    real = rows[other] != anchor[a]
                    heaps.push(a, line[real], ids[other][real], rows[other][real])
        for a, best in enumerate(heaps.kept):
            yield from ((int(anchor[a]), 0, *x) for x in best.tolist())
        return
    for mine, scores in _strips(queries, np.arange(len(own)), points, strip):
        for a, line in zip(mine, scores):
            heaps, different = Heaps(len(known[a]), rules.negatives), labels != own[a]
            for slot, positive in enumerate(known[a]):
                low, high = rules.window(positive)
                at = np.flatnonzero(different & (line >= low) & (line <= high)) if low <= high else ()
                if len(at):
                    heaps.push(slot, line[at], ids[at], rows[at])
            for slot, best in enumerate(heaps.kept):
                yield from ((int(anchor[a]), slot + 1, *x) for x in best.tolist())


def _strips(queries: np.ndarray, which: np.ndarray, points: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The products of some queries at a time with all points."""
    for i in range(0, len(which) if len(points) else 0, size):
        yield which[i:i + size], product(queries[which[i:i + size]], points)
