"""Exact top-k by integer inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size, and so are the queries to blocks. A (shard, block) pair is
one group: its task builds the shard's ball tree, lets each query read the leaf that promises most, and leaves out all
subtrees whose upper bound (|q| r + <q, c>, or |q| times the longest point) is below the query's k-th best score. What is left is read in the
order of the bounds. In a first round every query sees one shard only; the k-th score it finds there is the floor from
which all other shards prune. Vectors without clusters have bounds above nearly all scores: then nearly all leaves are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sealframe.llm.shared import kept

SHARD = 16_384  # vectors of a shard, about
BLOCK = 4_096  # queries of a block, about
LEAF = 128
PAIRS = 1 << 16  # queries and nodes that are compared at once
HITS = "query bigint, query_id bigint, vec_id bigint, score bigint"
# Integers up to this have exact sums in doubles.
EXACT = float(1 << 53)


class BallTree:
    """Halves at the median along the line between two points far apart, which parts clusters; identical points part by their order."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.centers, self.radii, self.longest, self.ranges, self.children = [], [], [], [], []
        self._build(0, len(points))
        self.centers, self.radii, self.longest = np.array(self.centers), np.array(self.radii), np.array(self.longest)
        self.children = np.array([c or (-1, -1) for c in self.children])

    def _build(self, a: int, b: int) -> int:
        own = self.points[self.order[a:b]]
        center = own.mean(axis=0)
        # A little more than the rounded radius, so that bounds never fall short.
        away = ((own - center) ** 2).sum(axis=1)
        node = len(self.centers)
        self.centers.append(center)
        self.radii.append(np.sqrt(away.max()) * (1 + 1e-9) + 1e-6)
        self.longest.append(np.sqrt((own ** 2).sum(axis=1).max()) * (1 + 1e-9) + 1e-6)
        self.ranges.append((a, b))
        self.children.append(None)
        if b - a > LEAF:
            far = own[away.argmax()]
            line = own[((own - far) ** 2).sum(axis=1).argmax()] - far
            half = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own @ line, half)]
            self.children[node] = self._build(a, a + half), self._build(a + half, b)
        return node

    def upper(self, queries: np.ndarray, norms: np.ndarray, node: np.ndarray) -> np.ndarray:
        """An upper bound of the products of each query with the points of the node beside it: from the ball, and from the longest point."""
        ball = (queries * self.centers[node]).sum(axis=1) + norms * self.radii[node]
        found = np.minimum(ball, norms * self.longest[node])
        return found + 1e-9 * np.abs(found) + 1e-6

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Upper bounds of all leaves for all queries, each also bounded by its ancestors'; the leaves."""
        leaves = [n for n, pair in enumerate(self.children) if pair[0] < 0]
        q, node, bound = self.reached(queries, np.full(len(queries), -np.inf))
        upper = np.zeros((len(queries), len(self.children)))
        upper[q, node] = bound
        return upper[:, leaves], leaves

    def reached(self, queries: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, leaf and bound of every leaf whose bound, and that of all nodes above it, is not below the query's floor.
        What is below a node that falls short is not looked at."""
        norms = np.sqrt((queries ** 2).sum(axis=1))
        q, node, bound = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.full(len(queries), np.inf)
        done = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        while len(q):
            bound = np.minimum(bound, np.concatenate([self.upper(queries[q[i:i + PAIRS]], norms[q[i:i + PAIRS]], node[i:i + PAIRS]) for i in range(0, len(q), PAIRS)]))
            go = bound >= floor[q]
            q, node, bound = q[go], node[go], bound[go]
            leaf = self.children[node, 0] < 0
            done.append((q[leaf], node[leaf], bound[leaf]))
            q, node, bound = (np.repeat(x[~leaf], 2) for x in (q, node, bound))
            node = self.children[node[::2]].ravel() if len(node) else node
        return tuple(np.concatenate(x) for x in zip(*done))

    def nearest(self, queries: np.ndarray) -> np.ndarray:
        """A leaf for each query, found by going where the bound is higher."""
        norms = np.sqrt((queries ** 2).sum(axis=1))
        node = np.zeros(len(queries), np.int64)
        while len(at := np.flatnonzero(self.children[node, 0] >= 0)):
            left, right = self.children[node[at]].T
            better = self.upper(queries[at], norms[at], left) >= self.upper(queries[at], norms[at], right)
            node[at] = np.where(better, left, right)
        return node


def search(points: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int,
           counted: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of each query's best ``k`` at or above its floor, ties to small ids.

    ``own`` is each query's id, whose points are left out. Scores are exact whatever their size. Each query reads the leaf that
    promises most first, and then, highest bound first, those that its k-th score so far does not rule out. ``counted`` gets how many
    leaves were read and how many there were.
    """
    tree = BallTree(points)
    big = np.abs(points).max(initial=0) * np.abs(queries).max(initial=0) * points.shape[1] >= EXACT
    best_score = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    exact: dict[tuple[int, int], int] = {}
    floor, read = floor.copy(), 0

    def visit(rows_of: np.ndarray, at: np.ndarray) -> None:
        nonlocal read
        read += len(at)
        order = np.argsort(at, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0, [True]]))
        for low, high in zip(edges, edges[1:]):
            rows = rows_of[order[low:high]]
            a, b = tree.ranges[at[order[low]]]
            members = tree.order[a:b]
            if big:
                scores = np.array([[sum(int(x) * int(y) for x, y in zip(queries[r], points[m])) for m in members] for r in rows], object)
                for r, line in zip(rows, scores):
                    exact.update({(r, ids[m]): s for m, s in zip(members, line)})
                scores = scores.astype(float)
            else:
                scores = queries[rows] @ points[members].T
            scores[own[rows][:, None] == ids[members][None, :]] = -np.inf
            joined = np.concatenate([best_score[rows], scores], axis=1)
            names = np.concatenate([best_id[rows], np.broadcast_to(ids[members], scores.shape)], axis=1)
            pick = np.lexsort((names, -joined), axis=1)[:, :k]
            best_score[rows] = np.take_along_axis(joined, pick, axis=1)
            best_id[rows] = np.take_along_axis(names, pick, axis=1)
            floor[rows] = np.maximum(floor[rows], best_score[rows, k - 1])

    first = tree.nearest(queries)
    visit(np.arange(len(queries)), first)
    # Strictly below the floor: an equal score may still win by its id.
    q, leaf, bound = tree.reached(queries, floor)
    other = leaf != first[q]
    q, leaf, bound = q[other], leaf[other], bound[other]
    order = np.lexsort((leaf, -bound, q))
    q, leaf, bound = q[order], leaf[order], bound[order]
    turn = np.arange(len(q)) - np.searchsorted(q, q)
    for step in range(int(turn.max(initial=-1)) + 1):
        at = np.flatnonzero(turn == step)
        at = at[bound[at] >= floor[q[at]]]
        if not len(at):
            break
        visit(q[at], leaf[at])
    if counted is not None:
        counted["read"], counted["leaves"] = read, len(queries) * int((tree.children[:, 0] < 0).sum())
    q, place = np.nonzero(best_score > -np.inf)
    found_ids = best_id[q, place]
    score = np.array([exact[x] for x in zip(q, found_ids)], object) if big else best_score[q, place].astype(np.int64)
    return q, found_ids, score


def integer_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """id and v = floor(scale * x) as doubles of each different row (vec_id, embedding).

    Null vectors, and those with a null or non-finite component, are left out, as are null ids and
    empty vectors. A row that is repeated whole counts once; different vectors of one id all count.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)) \
        .where(finite).select(F.col("vec_id").cast("bigint").alias("id"), F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v")).distinct()


def top_k(vectors: DataFrame, queries_of, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the ``k`` highest inner products of each query vector.

    ``queries_of`` is a condition on the id column; all other rows are candidates of a query, those
    of its own id and those of another length excepted. Queries with fewer candidates have fewer rows.
    """
    points = kept(integer_vectors(vectors, scale).withColumn("size", F.size("v")))
    # Rows per length: as many as there are lengths, for the number of shards and blocks of each.
    sizes = points.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum(queries_of(F.col("id")).cast("bigint")).alias("m"))
    split = sizes.select("size", F.ceil(F.col("n") / SHARD).cast("int").alias("shards"), F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")).where("m > 0")
    dealt = points.join(split, "size").withColumn("mix", F.xxhash64("id", "v"))
    home = F.pmod(F.col("mix"), F.col("shards")).cast("int")
    candidates = dealt.select("size", "shards", "blocks", home.alias("shard"), "id", "v")
    queries = dealt.where(queries_of(F.col("id"))).select(
        "size", "shards", home.alias("home"), F.pmod(F.shiftright("mix", 20), F.col("blocks")).cast("int").alias("block"),
        F.col("mix").alias("query"), "id", "v")

    everywhere = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = _searched(everywhere, queries.withColumn("shard", F.col("home")).withColumn("floor", F.lit(None).cast("bigint")), k)
    first = kept(first)
    # The k-th score of the first round, where there are k.
    floors = first.groupBy("query", "query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("found")) \
        .where(F.col("found") >= k).select("query", F.col("query_id").alias("id"), "floor")
    others = queries.join(floors, ["query", "id"], "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard != home")
    second = _searched(everywhere, others, k)
    # At most k rows per shard and query meet here.
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id")))
    ranked = first.unionByName(second).groupBy("query", "query_id").agg(F.slice(best, 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.less")).alias("score"))


def _searched(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best of every (size, shard, block) group that has queries."""
    keys = ["size", "shard", "block"]

    def matrix(table: pa.Table, name: str, size: int) -> np.ndarray:
        return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)

    def group(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        size = key[0].as_py()
        names = ["query", "query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        own, floor = right.column("q_id").to_numpy(), right.column("q_floor").to_pylist()
        floor = np.array([-np.inf if f is None else float(f) for f in floor])
        q, ids, scores = search(matrix(left, "v", size), left.column("id").to_numpy(), matrix(right, "q_v", size), own, floor, k)
        return pa.table([pa.array(right.column("q_query").to_numpy()[q], pa.int64()), pa.array(own[q], pa.int64()),
                         pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=names)

    left = candidates.select(*keys, "id", "v")
    # Names of their own, as both sides come from the same table.
    right = queries.select(*[F.col(c).alias(f"q_{c}") for c in (*keys, "query", "id", "v", "floor")])
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(group, HITS)
