"""Exact Jaccard join on word n-grams, by pivots, regions and the triangle inequality.

1. Filter. Of two sets that link, a known number of the n-grams that come first in a global (hash) order
   are common. A document whose first n-grams no other one has cannot link; what is left is
   filtered again by all its n-grams. Equal sets are one node from there on.
2. Pivots. Linked nodes share one of their first n-grams. Among the nodes with that n-gram the smallest
   is the pivot, so both lie in its region; a node near several pivots is in several regions.
3. Distances of all nodes to their pivots are exact. Nodes within the limit of the pivot are linked to
   it and hence to each other. A region in which others are left is joined recursively: nodes not
   yet connected become pivots in turn; a large region is cut into rings of equal distance to its
   pivot, and by the triangle inequality a ring meets only those within the limit.
4. Connected components of the links.

N-grams are 64-bit hashes; where hashes are shortened to ship them, a collision can only let
a document through that a later, exact step judges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sealframe.llm import bytehash
from sealframe.llm.components import components
from sealframe.llm.shared import kept, partitions
from sealframe.session import staging_folder

LOWER = np.arange(256)
LOWER[0x41:0x5B] += 0x20
LOWER_BYTES = bytehash.BYTES[LOWER]

# N-grams that a task gathers before it ships them, and those of the nodes of a region's cell, about;
# a task joins two cells. Few nodes of a cell may have many n-grams, so nodes are not what is counted.
FLUSH = 1_000_000
CELL = 400_000
RINGS = 20


@dataclass(frozen=True)
class Limit:
    """Two sets link when 100 * intersection >= ``percent`` * union."""

    percent: int = 75
    words: int = 5

    def spare(self, n: np.ndarray) -> np.ndarray:
        """How many elements of a set of size n may be missing in one it links with."""
        return n * (100 - self.percent) // 100

    def least(self, n: np.ndarray) -> np.ndarray:
        """The smallest set that one of size n can link with; also how much they share at least."""
        return -(-n * self.percent // 100)

    def first(self, n: np.ndarray) -> np.ndarray:
        """How many elements at the front of the order are looked at in the first filter."""
        return np.minimum(n, self.spare(n) + self.common(n))

    def common(self, n: np.ndarray) -> np.ndarray:
        """How many of those are common at least if the smaller set has size n; it grows with n."""
        return 1 + n // 8

    def links(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (a + b - both)


def shingle_sets(column, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct ``words``-grams of each text of an Arrow column, and their offsets.

    A to Z count as lower case. A text with fewer words has them all as one gram, one without any none.
    """
    buffer, offsets = bytehash.text_buffer(column)
    texts = len(offsets) - 1
    start, end, owner = bytehash.word_spans(buffer, offsets)
    hashes = bytehash.span_hashes(buffer, start, end, LOWER_BYTES)
    count = np.bincount(owner, minlength=texts)
    first = np.cumsum(count) - count
    grams, owners = [], []
    for size in range(1, words + 1):
        windows = bytehash.window_hashes(hashes, size)
        if size < words:
            at = first[count == size]
        else:
            at = np.flatnonzero(owner[:len(windows)] == owner[size - 1:]) if len(windows) else np.zeros(0, np.int64)
        # Grams of different sizes are different, whatever they hash to.
        grams.append(bytehash.mix(windows[at] + np.uint64(size)) if len(at) else np.zeros(0, np.uint64))
        owners.append(owner[at])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=texts))])


# Rows of the first shuffle of a filter. Entries of a batch in a bucket: ``keys`` (32 bits of the
# hash), ``places`` (the row with the gram, or -1 - i for the batch's i-th gram that several rows have) and
# ``times`` (how many have it). Or the batch's ``own`` rows. Rows of the second: what buckets tell a batch.
ENTRIES = "bucket int, batch bigint, keys binary, places binary, times binary, own binary"
TOLD = "batch bigint, bucket int, places binary, keys binary, times binary, own binary"
MOST = 65_535


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _per_row(sizes: np.ndarray, take: np.ndarray) -> np.ndarray:
    """A mask of the first ``take`` of each row's ``sizes`` elements."""
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return place < np.repeat(take, sizes)


def shared_grams(
    rows: DataFrame, schema: str, sets_of: Callable[[pa.RecordBatch], Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]],
    first: Callable[[np.ndarray], np.ndarray], need: Callable[[np.ndarray], np.ndarray], rarest: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """The rows that ``sets_of`` makes (of ``schema``), with ``alive``: whether at least ``need`` of the
    ``first`` grams of its set are in the first grams of another row's set.

    With ``rarest``, also ``tokens``: those of the so many rarest grams of the set that other sets
    have. Rarer is what fewer rows have, then what has the smaller hash: the same order for all.

    One entry per gram and batch is shuffled: rows of a batch with the same gram are its own affair, so
    a gram that every document has costs an entry per batch.
    """
    buckets, most = 2 * partitions(rows.sparkSession), FLUSH

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number, held, size = TaskContext.get().partitionId() << 24, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            batch = base + number
            number += 1
            sizes, grams = np.concatenate([s for _, _, s in held]), np.concatenate([g for _, g, _ in held])
            owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            order = np.argsort(grams, kind="stable")
            grams, owner = grams[order], owner[order]
            edges = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
            times = np.diff(np.append(edges, len(grams)))
            many = times > 1
            places = np.where(many, -np.cumsum(many), owner[edges]).astype("<i4")
            holders = owner[np.repeat(many, times)]
            own = pa.concat_tables([t for t, _, _ in held])
            packed = None, holders.astype("<i4").tobytes(), times[many].astype("<i4").tobytes(), _table_bytes(own)
            yield pa.RecordBatch.from_arrays([pa.array([batch % buckets], pa.int32()), pa.array([batch], pa.int64()),
                                              *[pa.array([x], pa.binary()) for x in packed]], names=_names(ENTRIES))
            keys = grams[edges]
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns = (keys[order] // np.uint64(buckets)).astype("<u4"), places[order], np.minimum(times[order], MOST).astype("<u2")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([batch] * len(full), pa.int64()),
                *[pa.array([c[cuts[b]:cuts[b + 1]].tobytes() for b in full], pa.binary()) for c in columns], pa.array([None] * len(full), pa.binary())], names=_names(ENTRIES))

        for batch in batches:
            for table, grams, sizes in sets_of(batch):
                take = first(sizes)
                held.append((table, grams[_per_row(sizes, take)], take))
                size += int(take.sum())
                if size >= most:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def told(table: pa.Table) -> pa.Table:
        batch, own, bucket = table.column("batch").to_pylist(), table.column("own").to_pylist(), table.column("bucket")[0].as_py()
        raw = [table.column(c).to_pylist() for c in ("keys", "places", "times")]
        out = [(batch[i], None, raw[1][i], None, raw[2][i], x) for i, x in enumerate(own) if x is not None]
        entry = [i for i, x in enumerate(own) if x is None]
        if entry:
            keys, places, times = (np.concatenate([np.frombuffer(c[i], kind) for i in entry]) for c, kind in zip(raw, ("<u4", "<i4", "<u2")))
            sizes = [len(raw[0][i]) // 4 for i in entry]
            order = np.argsort(keys, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
            total = np.zeros(len(keys), np.int64)
            total[order] = np.repeat(np.add.reduceat(times[order].astype(np.int64), edges), np.diff(np.append(edges, len(keys))))
            ends = np.cumsum(sizes)
            for i, a, b in zip(entry, ends - sizes, ends):
                at = np.flatnonzero(total[a:b] > 1) + a
                if len(at):
                    detail = (keys[at].tobytes(), np.minimum(total[at], MOST).astype("<u2").tobytes()) if rarest else (None, None)
                    out.append((batch[i], bucket, places[at].tobytes(), *detail, None))
        cols = list(zip(*out)) if out else [[]] * 6
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[2:]]], names=_names(TOLD))

    def judged(table: pa.Table) -> pa.Table:
        owns = table.column("own").to_pylist()
        mine = next(i for i, x in enumerate(owns) if x is not None)
        own = pa.ipc.open_stream(owns[mine]).read_all()
        raw = [table.column(c).to_pylist() for c in ("bucket", "places", "keys", "times")]
        holders, lists = np.frombuffer(raw[1][mine], "<i4"), np.frombuffer(raw[3][mine], "<i4")
        begin = np.cumsum(lists) - lists
        entry = [i for i, x in enumerate(owns) if x is None]
        places = np.concatenate([np.zeros(0, "<i4"), *[np.frombuffer(raw[1][i], "<i4") for i in entry]])
        # Every entry becomes one for each row that has the gram.
        several = places < 0
        index = -1 - places[several]
        count = np.ones(len(places), np.int64)
        count[several] = lists[index]
        start = np.zeros(len(places), np.int64)
        start[several] = begin[index]
        source = np.repeat(np.arange(len(places)), count)
        within = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
        row = places[source].astype(np.int64)
        inner = several[source]
        row[inner] = holders[(start[source] + within)[inner]]
        n = own.column("n").to_numpy()
        shared = np.bincount(row, minlength=len(n))
        alive = (n > 0) & (shared >= need(n))
        own = own.append_column("alive", pa.array(alive))
        if rarest:
            key = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(raw[2][i], "<u4") for i in entry]]).astype(np.uint64)
            key += np.repeat(np.array([raw[0][i] for i in entry], np.uint64) << np.uint64(32), [len(raw[1][i]) // 4 for i in entry])
            times = np.concatenate([np.zeros(0, "<u2"), *[np.frombuffer(raw[3][i], "<u2") for i in entry]])
            order = np.lexsort((key[source], times[source], row))
            # Grams that no other row has are the rarest; of the others so many remain to be taken.
            mask = _per_row(shared, np.where(alive, np.maximum(0, rarest(n) - (n - shared)), 0))
            tokens, per = key[source][order][mask], np.bincount(row[order][mask], minlength=len(n))
            ends = np.cumsum(per)
            own = own.append_column("tokens", pa.array([tokens[a:b].astype("<u8").tobytes() for a, b in zip(ends - per, ends)], pa.binary()))
        return own

    result = f"{schema}, alive boolean" + (", tokens binary" if rarest else "")
    return rows.mapInArrow(entries, ENTRIES).groupBy("bucket").applyInArrow(told, TOLD).groupBy("batch").applyInArrow(judged, result)


PROFILE = "doc_id bigint, key bigint, tie bigint, n bigint, node binary"
SETS = "node binary, n bigint, grams binary"


def _digest(grams: np.ndarray) -> bytes:
    return hashlib.md5(np.ascontiguousarray(grams, "<u8")).digest()


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, its hash ``tie``, and a key to find the row again: the id, or the tie where that is null."""
    doc_id, tie = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, tie).alias("key"), tie.alias("tie"), "text")


def _profile(docs: DataFrame, limit: Limit) -> DataFrame:
    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        for first, part in bytehash.slices(batch.column(3)):
            grams, offsets = shingle_sets(part, limit.words)
            nodes = [_digest(grams[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            sizes = np.diff(offsets)
            own = [batch.column(i).slice(first, len(part)) for i in range(3)]
            yield pa.table([*own, pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary())], names=["doc_id", "key", "tie", "n", "node"]), grams, sizes

    return shared_grams(_keyed(docs), PROFILE, sets_of, limit.first, lambda n: limit.common(limit.least(n)))


def _sets(docs: DataFrame, nodes: DataFrame, limit: Limit) -> DataFrame:
    """The sets of ``nodes`` (key, node), from the texts of the documents with these keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # rows of one key come one after the other
        for batch in batches:
            for first, part in bytehash.slices(batch.column(1)):
                grams, offsets = shingle_sets(part, limit.words)
                out = []
                for i, wanted in enumerate(batch.column(0).slice(first, len(part)).to_pylist()):
                    own = grams[offsets[i]:offsets[i + 1]]
                    if wanted not in seen and _digest(own) == wanted:
                        seen.add(wanted)
                        out.append((wanted, len(own), own.astype("<u8").tobytes()))
                cols = list(zip(*out)) if out else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], names=["node", "n", "grams"])

    # The nodes grow with the documents, so they are not broadcast where they happen to be few.
    return _keyed(docs).select("key", "text").join(nodes.select("key", "node").hint("merge"), "key").select("node", "text").mapInArrow(run, SETS)


def _unpack(column) -> list[np.ndarray]:
    """The n-grams of every row of an Arrow binary column, not copied."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    if not len(column):
        return []
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [whole[a:b].view("<u8") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` in all, or of one row."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _dense(sets: DataFrame, limit: Limit) -> DataFrame:
    """The nodes of which enough n-grams are in other nodes' sets for any link, with the ``tokens`` of
    which two linked nodes share at least one."""
    def sets_of(batch: pa.RecordBatch) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
        grams = _unpack(batch.column(2))
        for a, b in _groups([len(g) for g in grams], FLUSH // 2):
            table = pa.table([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)], names=["node", "n"])
            yield table, np.concatenate(grams[a:b]), np.array([len(g) for g in grams[a:b]])

    found = shared_grams(sets, "node binary, n bigint", sets_of, lambda n: n, limit.least, lambda n: limit.spare(n) + 1)
    return found.where("alive").select("node", "n", "tokens", F.monotonically_increasing_id().alias("num"))


def _regions(dense: DataFrame) -> DataFrame:
    """``x`` and ``pivot`` (numbers of nodes) for every region that a node other than its pivot is in."""
    buckets = 2 * partitions(dense.sparkSession)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, nums in ((t[a:b], batch.column(0).to_numpy()[a:b]) for batch in batches for t in [_unpack(batch.column(1))]
                             for a, b in _groups([len(x) for x in t], FLUSH)):
            every, num = np.concatenate(tokens), np.repeat(nums, [len(t) for t in tokens])
            bucket = (bytehash.mix(every) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([every[order][edges[b]:edges[b + 1]].astype("<u8").tobytes() for b in full], pa.binary()),
                pa.array([num[order][edges[b]:edges[b + 1]].astype("<i8").tobytes() for b in full], pa.binary())], names=["bucket", "tokens", "nums"])

    def pivots(table: pa.Table) -> pa.Table:
        token = np.concatenate(_unpack(table.column("tokens")))
        num = np.concatenate([np.frombuffer(x, "<i8") for x in table.column("nums").to_pylist()])
        order = np.lexsort((num, token))
        token, num = token[order], num[order]
        new = np.concatenate([[True], token[1:] != token[:-1]])[:len(token)]
        pivot = num[new][np.cumsum(new) - 1]
        pairs = np.unique(np.stack([num, pivot], axis=1)[num != pivot], axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["x", "pivot"])

    return dense.select("num", "tokens").mapInArrow(entries, "bucket int, tokens binary, nums binary") \
        .groupBy("bucket").applyInArrow(pivots, "x bigint, pivot bigint").distinct()


def _distances(regions: DataFrame, sets: DataFrame, limit: Limit) -> DataFrame:
    """``near`` (within the limit) and the exact Jaccard ``distance`` of every node to its pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, distance = [], []
            for a, b in zip(_unpack(batch.column(2)), _unpack(batch.column(3))):
                both = len(np.intersect1d(a, b, assume_unique=True))
                near.append(bool(limit.links(both, len(a), len(b))))
                distance.append(1 - both / (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_()), pa.array(distance, pa.float64()), batch.column(4)],
                                             names=["x", "pivot", "near", "distance", "size"])

    mine = sets.select(F.col("num").alias("x"), F.col("grams").alias("of_x"))
    theirs = sets.select(F.col("num").alias("pivot"), F.col("grams").alias("of_pivot"))
    return regions.join(mine, "x").join(theirs, "pivot").select("x", "pivot", "of_x", "of_pivot", "size") \
        .mapInArrow(run, "x bigint, pivot bigint, near boolean, distance double, size bigint")


def _small_links(members: DataFrame, sets: DataFrame, limit: Limit) -> DataFrame:
    """Links that connect what is linked in each of the regions, one task for a region."""
    rows = members.select("pivot", "x").union(members.select("pivot", "pivot").distinct())
    full = rows.join(sets.select(F.col("num").alias("x"), "grams"), "x")

    def join(table: pa.Table) -> pa.Table:
        num = table.column("x").to_numpy()
        found = region_links(_unpack(table.column("grams")), limit, pivot=int(np.flatnonzero(num == table.column("pivot")[0].as_py())[0]))
        return pa.table([pa.array([num[i] for i, _ in found], pa.int64()), pa.array([num[j] for _, j in found], pa.int64())], names=["a", "b"])

    return full.groupBy("pivot").applyInArrow(join, "a bigint, b bigint")


def _large_links(stars: DataFrame, sets: DataFrame, limit: Limit) -> DataFrame:
    """The same for regions in which distances to the pivot are known, for those of them with nodes
    beyond the limit: nodes near the pivot are linked to it. The pivot itself needs no further look."""
    open_ = stars.groupBy("pivot").agg(F.count(F.when(~F.col("near"), 1)).alias("far")).where("far > 0")
    members = stars.join(open_.select("pivot"), "pivot", "left_semi").withColumn("ring", F.floor(F.col("distance") * RINGS).cast("int"))
    counts = members.groupBy("pivot", "ring").agg(F.ceil(F.sum("size") / CELL).cast("int").alias("cells")) \
        .groupBy("pivot").agg(F.map_from_entries(F.collect_list(F.struct("ring", "cells"))).alias("cells"))  # RINGS + 1 at most
    width = -(-RINGS * (100 - limit.percent) // 100) + 1
    own = F.struct(F.col("ring"), F.pmod(F.xxhash64("x"), F.element_at("cells", F.col("ring"))).cast("int").alias("cell"))
    reach = F.sequence(F.greatest(F.col("ring") - width, F.lit(0)), F.least(F.col("ring") + width, F.lit(RINGS)))
    filled = F.filter(reach, lambda r: F.map_contains_key("cells", r))
    others = F.flatten(F.transform(filled, lambda r: F.transform(
        F.sequence(F.lit(0), F.element_at("cells", r) - 1), lambda c: F.struct(r.alias("ring"), c.alias("cell")))))
    dealt = members.join(counts, "pivot").withColumn("own", own).withColumn("other", F.explode(others)) \
        .withColumn("pair", F.struct(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")))
    full = dealt.select("pivot", "pair", "x", "near", "distance").join(sets.select(F.col("num").alias("x"), "grams"), "x")
    def join(table: pa.Table) -> pa.Table:
        num = table.column("x").to_numpy()
        near, distance = table.column("near").to_numpy(zero_copy_only=False), table.column("distance").to_numpy()
        found = region_links(_unpack(table.column("grams")), limit, near, distance)
        return pa.table([pa.array([num[i] for i, _ in found], pa.int64()), pa.array([num[j] for _, j in found], pa.int64())], names=["a", "b"])

    return full.groupBy("pivot", "pair").applyInArrow(join, "a bigint, b bigint")


def region_links(
    sets: list[np.ndarray], limit: Limit, near: np.ndarray | None = None, distance: np.ndarray | None = None, pivot: int | None = None,
) -> list[tuple[int, int]]:
    """Links that connect what is linked within a region, a spanning forest of it.

    ``pivot`` is held against all nodes first, or it is known from before who is ``near`` it and at which
    ``distance``. Near nodes are connected through it; every far one is in turn a pivot for all, of
    which by the triangle inequality those count that are about as far from the first.
    """
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    _, back = np.unique(every, return_inverse=True)
    order = np.argsort(back, kind="stable")
    holders = owner[order]
    begin = np.searchsorted(back[order], np.arange(back.max(initial=-1) + 2))
    offsets = np.concatenate([[0], np.cumsum(sizes)])

    def common(i: int) -> np.ndarray:
        grams = back[offsets[i]:offsets[i + 1]]
        lists = begin[grams + 1] - begin[grams]
        places = np.repeat(begin[grams] - (np.cumsum(lists) - lists), lists) + np.arange(int(lists.sum()))
        return np.bincount(holders[places], minlength=len(sets))

    found = []
    if near is None or distance is None:
        both = common(pivot)
        near, distance = limit.links(both, sizes[pivot], sizes), 1 - both / (sizes[pivot] + sizes - both)
        found = [(int(i), pivot) for i in np.flatnonzero(near) if i != pivot]
    label = np.arange(len(sets))
    if near.any():
        label[near] = np.flatnonzero(near)[0]
    slack = (100 - limit.percent) / 100 + 1e-9
    for i in np.flatnonzero(~near):
        ok = (np.abs(distance - distance[i]) <= slack) & (label != label[i])
        if ok.any():
            ok &= limit.links(common(i), sizes[i], sizes)
        for j in np.flatnonzero(ok):
            if label[j] != label[i]:
                found.append((int(i), int(j)))
                label[label == label[j]] = label[i]
    return found


def jaccard_classes(docs: DataFrame, limit: Limit = Limit()) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of
    ``docs`` (doc_id, text).

    A null or wordless text has no shingles and no links. Rows with equal sets are linked. Rows with a
    null id take part in links; a component of theirs alone has a null id. Repeated rows stay
    repeated. Also ``tie`` (a hash of the text), ``component`` (the same for all rows of a component,
    whatever their ids) and ``linked``: whether it has any other row.

    ``docs`` must give the same rows in the same order whenever a task reads them again, as a stored
    table does: batches refer to rows by number.
    """
    profile = kept(_profile(docs, limit))
    alive = profile.where("alive")
    with staging_folder(docs.sparkSession) as staged:
        nodes = kept(alive.groupBy("node").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first"), F.count(F.lit(1)).alias("rows"))
            .select("node", F.col("first.key").alias("key"), F.col("first.doc_id").alias("doc_id"), "rows"), staged)
        sets = kept(_sets(docs, nodes, limit), staged)
        dense = kept(_dense(sets, limit), staged)
        own = kept(sets.select("node", "grams").join(dense.select("node", "num", "n"), "node"), staged)
        members = kept(_regions(dense).join(own.select(F.col("num").alias("x"), F.col("n").alias("size")), "x"), staged)
        sizes = members.groupBy("pivot").agg(F.sum("size").alias("m"))
        large = sizes.where(F.col("m") > CELL).select("pivot")
        stars = kept(_distances(members.join(large, "pivot", "left_semi"), own, limit), staged)
        near = stars.where("near").select(F.col("x").alias("a"), F.col("pivot").alias("b"))
        small = _small_links(members.join(large, "pivot", "left_anti"), own, limit)
        links = kept(small.union(near).union(_large_links(stars, own, limit)), staged)
        roots = components(links, staged).withColumnRenamed("node", "num")
        named = dense.select("num", "node").join(roots, "num").select("node", "root").distinct().join(nodes.select("node", "doc_id"), "node")
        least = named.groupBy("root").agg(F.min("doc_id").alias("least"), F.min("node").alias("component"))
        # A table of its own: in the last join a node that a third of all rows have can then be split.
        classes = kept(nodes.join(named.join(least, "root").select("node", "least", "component"), "node", "left").select(
            "node", F.coalesce("least", "doc_id").alias("class"), F.coalesce("component", "node").alias("component"),
            (F.col("component").isNotNull() | (F.col("rows") > 1)).alias("linked")))
    return profile.join(classes, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class", "doc_id").alias("component_id"), "tie",
        F.coalesce("component", "node").alias("component"), F.coalesce("linked", F.lit(False)).alias("linked"))


def one_per_component(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``docs`` (with doc_id, text) without all but one row of every component of ``classes``.

    The row with the smallest id stays, a null id being the largest, then that with the smallest hash
    of its text; of rows equal in both one stays. Rows without a link all stay.
    """
    linked = classes.where("linked")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "tie")
    # Tables of their own, so that the joins can split a component or a row that is there very often.
    winners = kept(linked.groupBy("component").agg(F.min(rank).alias("winner")))
    marks = linked.join(winners, "component").groupBy(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).agg(
        F.min(rank == F.col("winner")).alias("__stays"), (F.count(F.lit(1)) > 1).alias("__again")).where("not __stays or __again")
    marked = docs.join(kept(marks).hint("merge"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__tie")), "left") \
        .where(F.coalesce("__stays", F.lit(True)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = marked.where("__again").dropDuplicates(["__id", "__tie"]).select(*columns)
    return marked.where("__again is null or not __again").select(*columns).union(once)
