"""Hierarchical packing of whole documents into token sequences of several context sizes.

Tiers are powers of two from the longest context down. A document's ids fill whole long windows first;
what is left is routed to the smallest tier that holds it. Each long window's gap is filled from the
shorter tiers, longest fitting piece first, then by cutting one piece; then the shorter tiers are
packed the same way. A tier's last window stays open until more pieces come. Only the last pieces of
a task are cut to powers of two, so nothing is padded but a remainder below the last of them.

Packing needs no shuffle: a task packs the documents it reads, a bounded pool at a time. Steps go over all tasks: the sequences of a
context are numbered throughout, and so many in a row make a step.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sealframe.llm.shared import kept
from sealframe.llm.tokens import document_ids

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, context int, step_id bigint")
# Sequence numbers are those of the task, its partition in the upper bits. Steps have their context's bits in the lower ones.
TASK_BITS, CONTEXT_BITS = 40, 6
PLACED = PIECES.replace("step_id bigint", "task int, nth bigint")


@dataclass(frozen=True)
class Tiers:
    """``longest`` and ``shortest`` context, powers of two; ``pool``: ids that a task gathers before it packs;
    ``step``: ids of a training step, all of whose sequences have the same context; ``tail``: the smallest power of
    two that the last pieces of a task are cut to, the shortest context if none is named."""

    longest: int = 4096
    shortest: int = 256
    pool: int = 1 << 20
    step: int = 1 << 16
    tail: int | None = None

    def sizes(self, last: int | None = None) -> list[int]:
        """From the longest down to the shortest, or to ``last``."""
        return [1 << k for k in range(self.longest.bit_length() - 1, (last or self.shortest).bit_length() - 2, -1)]

    def per_step(self, context: int) -> int:
        return max(1, self.step // context)


@dataclass(order=True)
class Piece:
    length: int
    order: int
    doc: int = field(compare=False)
    start: int = field(compare=False)


class Packer:
    """Packs pieces by length; knows documents by number only. ``done`` gets (context, pieces)."""

    def __init__(self, tiers: Tiers):
        self.tiers, self.order = tiers, 0
        self.waiting: dict[int, list[Piece]] = {s: [] for s in tiers.sizes()}  # sorted by length
        self.done: list[tuple[int, list[Piece]]] = []

    def route(self, doc: int, start: int, length: int) -> None:
        for size in reversed(self.tiers.sizes()):
            if length <= size:
                self.order += 1
                insort(self.waiting[size], Piece(length, self.order, doc, start))
                return
        raise ValueError("longer than the longest context")

    def add(self, doc: int, length: int) -> None:
        longest, start = self.tiers.longest, 0
        while length - start >= longest:
            self.done.append((longest, [Piece(longest, 0, doc, start)]))
            start += longest
        if start < length:
            self.route(doc, start, length - start)

    def fill(self, window: list[Piece], gap: int, size: int) -> int:
        """Fill a window from its own tier and the shorter ones; what is left of the gap."""
        for tier in (s for s in self.tiers.sizes() if s <= size):
            pieces = self.waiting[tier]
            while gap and pieces and pieces[0].length <= gap:
                piece = pieces.pop(bisect_right(pieces, gap, key=lambda p: p.length) - 1)
                window.append(piece)
                gap -= piece.length
        if gap:
            # Nothing fits whole: cut the shortest piece that is there; its rest is routed anew.
            for tier in reversed([s for s in self.tiers.sizes() if s <= size]):
                if self.waiting[tier]:
                    piece = self.waiting[tier].pop(0)
                    window.append(Piece(gap, 0, piece.doc, piece.start))
                    self.route(piece.doc, piece.start + gap, piece.length - gap)
                    return 0
        return gap

    def pack(self) -> None:
        """Close every window that can be filled; the others go back to wait."""
        for size in self.tiers.sizes():
            while self.waiting[size]:
                piece = self.waiting[size].pop()
                window = [piece]
                if self.fill(window, size - piece.length, size):
                    for p in window:
                        self.route(p.doc, p.start, p.length)
                    break
                self.done.append((size, window))

    def finish(self) -> None:
        """Cut all that waits to powers of two; the rest below the last one is one padded sequence."""
        self.pack()
        left = sorted((p for pieces in self.waiting.values() for p in pieces), reverse=True)
        for size in self.tiers.sizes(self.tiers.tail):
            while sum(p.length for p in left) >= size:
                window, gap = [], size
                while gap:
                    piece = left.pop(0)
                    take = min(gap, piece.length)
                    window.append(Piece(take, 0, piece.doc, piece.start))
                    gap -= take
                    if take < piece.length:
                        left.insert(0, Piece(piece.length - take, 0, piece.doc, piece.start + take))
                self.done.append((size, window))
        if left:
            self.done.append((self.tiers.longest, left))
        self.waiting = {s: [] for s in self.tiers.sizes()}


class Steps:
    """Deals the sequences of each context to steps of about as many ids, one context to a step."""

    def __init__(self, tiers: Tiers):
        self.tiers, self.count = tiers, Counter()

    def number(self, context: int) -> int:
        """How many sequences of the context came before."""
        self.count[context] += 1
        return self.count[context] - 1

    def of(self, context: int) -> int:
        return (self.number(context) // self.tiers.per_step(context) << CONTEXT_BITS) + context.bit_length()


def _stepped(placed: DataFrame, tiers: Tiers) -> DataFrame:
    """Pieces with the step of their sequence among those of all tasks. A row for each task and context is broadcast."""
    counts = placed.groupBy("task", "context").agg((F.max("nth") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("context").orderBy("task")) - F.col("n")
    counts = counts.select(F.col("task").alias("of_task"), F.col("context").alias("of_context"), before.alias("before"))
    step = F.shiftleft(F.floor((F.col("before") + F.col("nth")) / F.greatest(F.lit(1), F.floor(F.lit(tiers.step) / F.col("context")))), CONTEXT_BITS) + F.length(F.bin("context"))
    return placed.join(F.broadcast(counts), (F.col("task") == F.col("of_task")) & (F.col("context") == F.col("of_context"))).select(
        *[c.split()[0] for c in PIECES.split(", ")][:-1], step.cast("bigint").alias("step_id"))


def pack_documents(docs: DataFrame, tokenizer: str, end: int, tiers: Tiers = Tiers(tail=1)) -> DataFrame:
    """The pieces of all documents (doc_id, text), each id of a document in exactly one.

    A document is the ids of its whole text and then ``end``; a null text is empty, so it is one id.
    ``context`` is the size of the sequence, ``offset`` the piece's place in it. By default every sequence is full: a task's last
    pieces are cut down to 1, so they make at most one sequence of each power of two below the shortest tier. All steps of a context
    have as many sequences, but for its last one. Null and repeated
    doc_ids are packed like others, row by row. Which documents meet in a sequence depends on how the
    input is split, which a task that is run again reads the same way.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        base = task << TASK_BITS
        packer, steps, known, sequence, pool, number = Packer(tiers), Steps(tiers), {}, 0, 0, 0

        def emit() -> pa.RecordBatch:
            nonlocal sequence
            rows = []
            for context, window in packer.done:
                offset, nth = 0, steps.number(context)
                for p in window:
                    doc_id, ids = known[p.doc]
                    crc = zlib.crc32(np.ascontiguousarray(ids[p.start:p.start + p.length]))
                    rows.append((doc_id, p.start, p.length, crc, len(ids), base + sequence, offset, context, task, nth))
                    offset += p.length
                sequence += 1
            packer.done.clear()
            # Of the documents, those with a waiting piece stay.
            waiting = {p.doc for pieces in packer.waiting.values() for p in pieces}
            for doc in [d for d in known if d not in waiting]:
                del known[doc]
            columns = list(zip(*rows)) if rows else [[]] * 10
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PLACED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), document_ids(batch.column(1), tokenizer, end)):
                known[number] = doc_id, ids.copy()
                packer.add(number, len(ids))
                number, pool = number + 1, pool + len(ids)
                if pool >= tiers.pool:
                    packer.pack()
                    yield emit()
                    pool = 0
        packer.finish()
        yield emit()

    # Written, as the tasks' numbers of sequences are known only then.
    return _stepped(kept(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(packed, PLACED)), tiers)
