"""Passages that repeat across documents, exactly or with edits, by seeds, chains and alignment.

1. Seeds: the winnowed hashes of a text's runs of ``seed`` words, which edited passages still share, and of its runs of
   ``long`` words, which only texts with all of these share. Every seed that several documents have is matched with its first
   occurrence (smallest document id), so the number of matches is that of the seeds. A passage whose parts have first
   occurrences of their own, in different documents, is found by its long seeds.
2. Chains: the matches of a document with one earlier document, merged to runs, are chained in
   order by dynamic programming with gap costs, the best run before each from a Fenwick tree that runs beyond
   the gap leave.
3. Alignment: the words under each chain, and some on both sides, are aligned; the chain's passage is
   the stretch with the highest score around it, or, where too few of its words agree, every stretch
   within it that is a passage by itself.

Of a passage, all occurrences but that in the earliest document are reported.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from sealframe.llm import bytehash
from sealframe.llm.html_text import shared_lines
from sealframe.llm.ngram_join import LOWER_BYTES
from sealframe.llm.shared import kept, partitions
from sealframe.session import staging_folder

FLUSH = 750_000  # seeds that a task gathers before it ships them


@dataclass(frozen=True)
class Passage:
    """``words``: the shortest passage; ``same``: the least part of its words that agree.

    ``seed``, ``long`` and ``window``: every run of seed + window - 1 words that two texts share has a common seed, and every one of
    long + window - 1 words a common long seed.
    ``gap``: words that a chain may skip at once, ``gap_cost``: score that each takes. ``chain``: words
    that a chain spans at least. ``margin``: words around a chain that are aligned too.
    """

    words: int = 50
    same: float = 0.7
    seed: int = 6
    long: int = 43
    window: int = 8
    gap: int = 32
    gap_cost: float = 0.25
    chain: int = 12
    margin: int = 32


def seeds(column, how: Passage) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, text number, first word of the winnowed seeds of an Arrow column of texts, and the first
    word of the text's first seed with the same words. Words of long seeds are given as -1 - word.

    Of every ``window`` runs in a row the one with the smallest hash is taken (all that have it), of a text with fewer the
    first smallest (none for long seeds). The n-th seed of a text with the same words has a key for n, so that texts which repeat
    themselves are matched repetition by repetition.
    """
    buffer, offsets = bytehash.text_buffer(column)
    start, end, owner = bytehash.word_spans(buffer, offsets)
    hashes = bytehash.span_hashes(buffer, start, end, LOWER_BYTES)
    short, long = _winnowed(hashes, owner, len(offsets) - 1, how.seed, how.window, True), _winnowed(hashes, owner, len(offsets) - 1, how.long, how.window, False)
    return tuple(np.concatenate([a, b if i < 2 else -1 - b]) for i, (a, b) in enumerate(zip(short, long)))


def _winnowed(hashes: np.ndarray, owner: np.ndarray, texts: int, size: int, window: int, few: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of one size; ``few``: whether texts with less than ``window`` runs have one too."""
    runs = bytehash.window_hashes(hashes, size)
    if not len(runs):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Seeds of different sizes are different, whatever they hash to.
    runs = runs if few else bytehash.mix(runs + np.uint64(size))
    whole = owner[:len(runs)] == owner[size - 1:]
    text, runs = owner[:len(runs)][whole], runs[whole]
    first_word = np.searchsorted(owner, np.arange(texts))
    word = np.flatnonzero(whole) - first_word[text]
    taken = np.zeros(len(runs), bool)
    if len(runs) >= window:
        # The smallest of every ``window`` in a row, by minima of ever more.
        least, many = runs, 1
        while many < window:
            step = min(many, window - many)
            least, many = np.minimum(least[:-step], least[step:]), many + step
        inside = text[:len(least)] == text[window - 1:]
        for j in range(window):
            taken[j:j + len(least)] |= inside & (runs[j:j + len(least)] == least)
    count = np.bincount(text, minlength=texts)
    begin = np.cumsum(count) - count
    for t in np.flatnonzero((count > 0) & (count < window)) if few else ():
        taken[begin[t] + runs[begin[t]:begin[t] + count[t]].argmin()] = True
    runs, text, word = runs[taken], text[taken], word[taken]
    order = np.lexsort((word, runs, text))
    runs, text, word = runs[order], text[order], word[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    turn = (np.arange(len(runs)) - lead).astype(np.uint64)
    return np.where(turn > 0, bytehash.mix(runs + turn), runs), text, word, word[lead]


class Fenwick:
    """The best (score, item) among the positions up to a given one. Items are put with rising ``x``, and those below a
    least ``x`` can be left out."""

    def __init__(self, size: int):
        # A node's items that may still be the best: with falling scores, the best one first.
        self.best: list[deque[tuple[float, float, int]] | None] = [None] * (size + 1)

    def put(self, at: int, score: float, item: int, x: float = 0) -> None:
        at += 1
        while at < len(self.best):
            held = self.best[at] = self.best[at] or deque()
            while held and held[-1][1] <= score:
                held.pop()
            held.append((x, score, item))
            at += at & -at

    def get(self, to: int, least: float = -np.inf) -> tuple[float, int]:
        to, found = to + 1, (-np.inf, -1)
        while to > 0:
            held = self.best[to]
            while held and held[0][0] < least:
                held.popleft()
            if held and held[0][1] > found[0]:
                found = held[0][1:]
            to -= to & -to
        return found


class Nearest:
    """The best (score, item) among the runs that end no more than ``gap`` words before a place in both texts. They
    are put in the order of their ends in x.

    End places in p are cut into blocks of gap + 1. Those within the gap of a place are the first ones of its block and the last
    ones of the block before, so a block has a tree for either.
    """

    def __init__(self, gap: int):
        self.gap, self.width = gap, gap + 1
        self.blocks: dict[int, tuple[Fenwick, Fenwick]] = {}

    def put(self, x: int, p: int, score: float, item: int) -> None:
        block, at = divmod(p, self.width)
        if block not in self.blocks:
            self.blocks[block] = Fenwick(self.width), Fenwick(self.width)
        first, last = self.blocks[block]
        first.put(at, score, item, x)
        last.put(self.width - 1 - at, score, item, x)

    def get(self, x: int, ends: range) -> tuple[float, int]:
        """Of those that end in p at one of ``ends``, the places within the gap, for a place at ``x``."""
        block, at = divmod(ends[-1], self.width)
        found = (-np.inf, -1)
        if block in self.blocks:
            found = self.blocks[block][0].get(at, x - self.gap)
        if at < self.width - 1 and block - 1 in self.blocks:
            found = max(found, self.blocks[block - 1][1].get(self.width - 2 - at, x - self.gap))
        return found


def chains(x: np.ndarray, p: np.ndarray, how: Passage, size: np.ndarray | None = None) -> list[tuple[int, int, int, int, bool]]:
    """Chains of matches between words from ``x`` of one text and from ``p`` of another, each of ``size`` words (by default a
    seed's): their spans in both, and whether all matches lie on one diagonal. Highest score first; no match is in two chains."""
    size = np.full(len(x), how.seed) if size is None else size
    order = np.lexsort((x, p - x))
    x, p, size = x[order], p[order], size[order]
    # Matches on a diagonal with no more than a gap between them are one run. Words that winnowing leaves between two are none.
    slack = max(how.seed, how.window)
    line = np.concatenate([[0], np.cumsum(np.diff(p - x) != 0)]) << 33
    reach = np.maximum.accumulate(line + x + np.maximum(size, slack)) - line
    end = np.maximum.accumulate(line + x + size) - line
    between = x[1:] - reach[:-1]
    cut = np.flatnonzero((np.diff(line) != 0) | (between > how.gap - slack)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(x)]]) - 1
    # Words between two matches of a run cost what a gap does.
    gaps = np.concatenate([[0], np.cumsum(np.maximum(0, between))])
    own = (end[last] - x[first] - (1 + 2 * how.gap_cost) * (gaps[last] - gaps[first])).tolist()
    spans = zip(x[first].tolist(), end[last].tolist(), p[first].tolist(), (end[last] + (p - x)[last]).tolist(), own)
    runs = sorted(spans)
    if len(runs) == 1:
        best = [[0]]
    else:
        near = Nearest(how.gap)
        score, before = [0.0] * len(runs), [-1] * len(runs)
        done = sorted(range(len(runs)), key=lambda i: runs[i][1])
        at = 0
        for i, (xa, _, pa_, _, own) in enumerate(runs):
            while at < len(done) and runs[done[at]][1] <= xa:
                j = done[at]
                near.put(runs[j][1], runs[j][3], score[j] + how.gap_cost * (runs[j][1] + runs[j][3]), j)
                at += 1
            score[i] = own
            value, j = near.get(xa, range(pa_ - how.gap, pa_ + 1))
            value -= how.gap_cost * (xa + pa_)
            if j >= 0 and value > 0:
                score[i], before[i] = score[i] + value, j
        best, used = [], [False] * len(runs)
        for i in sorted(range(len(runs)), key=lambda i: -score[i]):
            chain = []
            while i >= 0 and not used[i]:
                used[i] = True
                chain.append(i)
                i = before[i]
            if chain:
                best.append(chain[::-1])
    found = []
    for chain in best:
        a, b = runs[chain[0]], runs[chain[-1]]
        if b[1] - a[0] >= how.chain:
            found.append((a[0], b[1], a[2], b[3], len({r[2] - r[0] for r in (runs[i] for i in chain)}) == 1))
    return found


ENTRIES = "bucket int, batch bigint, keys binary, docs binary, words binary, own binary"
FOUND = "batch bigint, docs binary, words binary, to_docs binary, to_words binary, own binary"
CHAINS = "doc bigint, start int, end int, to_doc bigint, to_start int, to_end int, straight boolean"


def _find(docs: np.ndarray, words: np.ndarray, doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Where (doc, word) is among the given pairs, or -1."""
    if not len(docs) or not len(doc):
        return np.full(len(doc), -1)
    # Document numbers of this batch are few, so a pair fits one integer.
    names, code = np.unique(docs, return_inverse=True)
    at = np.minimum(np.searchsorted(names, doc), len(names) - 1)
    pairs, asked = code * (1 << 32) + words, at * (1 << 32) + word
    order = np.argsort(pairs, kind="stable")
    place = np.minimum(np.searchsorted(pairs[order], asked), len(pairs) - 1)
    return np.where((pairs[order][place] == asked) & (names[at] == doc), order[place], -1)


def chained(rows: DataFrame, how: Passage) -> DataFrame:
    """Chains of every document of ``rows`` (key, text) with earlier ones.

    A batch sends the first of its occurrences of a seed, and matches the others itself, so a seed
    that every document has costs a row per batch.
    """
    buckets, most = 2 * partitions(rows.sparkSession), FLUSH

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ENTRIES.split(", ")]
        base, number, held, size = TaskContext.get().partitionId() << 24, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            batch = base + number
            number += 1
            key, doc, word, base_word = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((word, doc, key))
            key, doc, word, base_word = key[order], doc[order], word[order], base_word[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            other = np.flatnonzero(~new)
            # The batch's later occurrences, each with the batch's first one; and repetitions in a text.
            again = np.flatnonzero(word != base_word)
            own = np.concatenate([[len(other)], doc[other], word[other], doc[lead[other]], word[lead[other]],
                                  doc[again], word[again], base_word[again]]).astype("<i8").tobytes()
            none = pa.array([None], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([batch % buckets], pa.int32()), pa.array([batch], pa.int64()), none, none, none, pa.array([own], pa.binary())], names=names)
            key, doc, word = key[new], doc[new], word[new]
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            parts = (key[order] // np.uint64(buckets)).astype("<u8"), doc[order].astype("<i8"), word[order].astype("<i4")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [b for b in range(buckets) if edges[b] < edges[b + 1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([batch] * len(full), pa.int64()),
                *[pa.array([a[edges[b]:edges[b + 1]].tobytes() for b in full], pa.binary()) for a in parts], pa.array([None] * len(full), pa.binary())], names=names)

        for batch in batches:
            for first, part in bytehash.slices(batch.column(1)):
                key, text, word, base_word = seeds(part, how)
                held.append((key, batch.column(0).slice(first, len(part)).to_numpy()[text], word, base_word))
                size += len(key)
                if size >= most:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def first_ones(table: pa.Table) -> pa.Table:
        """Each batch's first occurrences with those of all batches, where a seed is in several."""
        batch, own = table.column("batch").to_pylist(), table.column("own").to_pylist()
        keys, docs, words = ([np.frombuffer(x or b"", kind) for x in table.column(c).to_pylist()] for c, kind in (("keys", "<u8"), ("docs", "<i8"), ("words", "<i4")))
        source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        key, doc, word = np.concatenate(keys), np.concatenate(docs), np.concatenate(words)
        order = np.lexsort((word, doc, key))
        key, doc, word, source = key[order], doc[order], word[order], source[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.zeros(0, np.int64)
        other = np.flatnonzero(~new)
        other = other[np.argsort(source[other], kind="stable")]
        edges = np.searchsorted(source[other], np.arange(len(keys) + 1))
        out = [(batch[i], None, None, None, None, x) for i, x in enumerate(own) if x is not None]
        for i in range(len(keys)):
            at = other[edges[i]:edges[i + 1]]
            if len(at):
                out.append((batch[i], doc[at].tobytes(), word[at].tobytes(), doc[lead[at]].tobytes(), word[lead[at]].tobytes(), None))
        cols = list(zip(*out)) if out else [[]] * 6
        return pa.table([pa.array(cols[0], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[1:]]], names=[c.split()[0] for c in FOUND.split(", ")])

    def chain(table: pa.Table) -> pa.Table:
        def joined(name: str, kind: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(x or b"", kind) for x in table.column(name).to_pylist()]).astype(np.int64)

        doc, word, to_doc, to_word = joined("docs", "<i8"), joined("words", "<i4"), joined("to_docs", "<i8"), joined("to_words", "<i4")
        own = next(np.frombuffer(x, "<i8") for x in table.column("own").to_pylist() if x is not None)
        later, again = own[1:1 + 4 * own[0]].reshape(4, -1), own[1 + 4 * own[0]:].reshape(3, -1)
        # The batch's later occurrences go where its first one went, or to it.
        at = _find(doc, word, later[2], later[3])
        to = [np.where(at >= 0, t[at], l) if len(t) else l for t, l in ((to_doc, later[2]), (to_word, later[3]))]
        doc, word = np.concatenate([doc, later[0]]), np.concatenate([word, later[1]])
        to_doc, to_word = np.concatenate([to_doc, to[0]]), np.concatenate([to_word, to[1]])
        other = doc != to_doc
        doc, word, to_doc, to_word = doc[other], word[other], to_doc[other], to_word[other]
        # A repetition that no other document has goes where the text's first one went.
        at = _find(doc, word, again[0], again[2])
        alone = (_find(doc, word, again[0], again[1]) < 0) & (at >= 0)
        doc, word = np.concatenate([doc, again[0][alone]]), np.concatenate([word, again[1][alone]])
        to_doc, to_word = np.concatenate([to_doc, to_doc[at[alone]]]), np.concatenate([to_word, to_word[at[alone]]])
        long = word < 0
        size = np.where(long, how.long, how.seed)
        word, to_word = np.where(long, -1 - word, word), np.where(long, -1 - to_word, to_word)
        order = np.lexsort((word, to_doc, doc))
        doc, word, to_doc, to_word, size = doc[order], word[order], to_doc[order], to_word[order], size[order]
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(to_doc) != 0)])) if len(doc) else np.zeros(0, np.int64)
        ends = np.append(edges[1:], len(doc))
        enough = (np.maximum.reduceat(word + size, edges) - word[edges] >= how.chain).tolist() if len(doc) else []
        out = [(int(doc[a]), *spans[:2], int(to_doc[a]), *spans[2:]) for a, b, good in zip(edges.tolist(), ends.tolist(), enough) if good
               for spans in chains(word[a:b], to_word[a:b], how, size[a:b])]
        cols = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in CHAINS.split(", ")])

    return rows.select("key", "text").mapInArrow(entries, ENTRIES).groupBy("bucket").applyInArrow(first_ones, FOUND) \
        .groupBy("batch").applyInArrow(chain, CHAINS)


def agreement(a: np.ndarray, b: np.ndarray, shift: int, straight: bool) -> np.ndarray:
    """Which words of ``a`` agree with the words of ``b`` that they are aligned with."""
    same = np.zeros(len(a), bool)
    if straight:
        low, high = max(0, -shift), min(len(a), len(b) - shift)
        same[low:high] = a[low:high] == b[low + shift:high + shift]
    else:
        same[[i for i, _ in shared_lines(a, b)]] = True
    return same


def around(same: np.ndarray, xa: int, xb: int) -> tuple[int, int, int]:
    """Start and end of the best stretch that has the words from ``xa`` to ``xb``, and how many of its
    words agree. An equal word scores 1, another one -2 outside of these."""
    score = np.where(same, 1, -2)
    left, right = np.cumsum(score[:xa][::-1]), np.cumsum(score[xb:])
    start = xa - (int(left.argmax()) + 1 if len(left) and left.max() > 0 else 0)
    end = xb + (int(right.argmax()) + 1 if len(right) and right.max() > 0 else 0)
    return start, end, int(same[start:end].sum())


def align(a: np.ndarray, b: np.ndarray, at: tuple[int, int, int, int], straight: bool, how: Passage) -> tuple[int, int, int]:
    """Start and end in ``a`` of the best stretch around the chain ``at`` (its spans in a and b), and
    how many of its words agree."""
    return around(agreement(a, b, at[2] - at[0], straight), *at[:2])


def pieces(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The stretches of highest score, one after the other, that score ``least`` or more."""
    todo, found = [(0, len(same))], []
    while todo:
        a, b = todo.pop()
        total = np.concatenate([[0], np.cumsum(np.where(same[a:b], 1, -2))])
        gain = total - np.minimum.accumulate(total)
        end = int(gain.argmax())
        if gain[end] >= least:
            start = end - int(total[end::-1].argmin())
            found.append((a + start, a + end))
            todo += [(a, a + start), (a + end, b)]
    return sorted(found)


def stretches(same: np.ndarray, how: Passage) -> list[tuple[int, int, int]]:
    """The passages within aligned words: of all stretches from the start of a piece that scores as much
    as a seed to the end of one, those with enough words and agreement, the best first, and then those
    on both sides of it."""
    if same.sum() < how.same * how.words:
        return []
    cuts, count = pieces(same, how.seed), np.concatenate([[0], np.cumsum(same)])
    # The words that agree beyond the least part.
    level = count - how.same * np.arange(len(count))
    todo, found = [(0, len(cuts))], []
    while todo:
        low, high = todo.pop()
        best, first, lead = (-np.inf, -1, -1), low, -1
        for j in range(low, high):
            while first <= j and cuts[j][1] - cuts[first][0] >= how.words:
                if lead < 0 or level[cuts[first][0]] < level[cuts[lead][0]]:
                    lead = first
                first += 1
            if lead >= 0:
                best = max(best, (level[cuts[j][1]] - level[cuts[lead][0]], lead, j))
        if best[0] >= -1e-9:
            _, i, j = best
            start, end = cuts[i][0], cuts[j][1]
            found.append((start, end, int(count[end] - count[start])))
            todo += [(low, i), (j + 1, high)]
    return sorted(found)


def passages_of(a: np.ndarray, b: np.ndarray, at: tuple[int, int, int, int], straight: bool, how: Passage) -> list[tuple[int, int, int]]:
    """The passages in ``a`` under and around the chain ``at``: all of it, or else those within it."""
    same = agreement(a, b, at[2] - at[0], straight)
    start, end, n = around(same, *at[:2])
    if end - start >= how.words and n >= how.same * (end - start):
        return [(start, end, n)]
    return stretches(same, how)


SLICES = "chain bigint, mine boolean, doc_id bigint, tie bigint, first int, start int, end int, straight boolean, words binary"
ALIGNED = "doc_id bigint, tie bigint, start_word int, end_word int, from_doc bigint, same_words int"
MERGED = "doc_id bigint, tie bigint, start_word int, end_word int, n_words int, from_doc bigint, same_words int"
TOGETHER = 1024  # chains with numbers in a row that ask a text for their words at once


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def _slices(rows: DataFrame, found: DataFrame, how: Passage) -> DataFrame:
    """The hashed words under and around every chain, one row for each of its two sides."""
    asked = found.select(F.col("doc").alias("key"), "chain", F.lit(True).alias("mine"), "start", "end", "straight").union(
        found.select("to_doc", "chain", F.lit(False), "to_start", "to_end", "straight"))
    lists = asked.groupBy("key", F.floor(F.col("chain") / TOGETHER).alias("part")).agg(
        F.collect_list(F.struct("chain", "mine", "start", "end", "straight")).alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, tie = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                buffer, offsets = bytehash.text_buffer(batch.column(2).slice(i, 1))
                a, b, _ = bytehash.word_spans(buffer, offsets)
                words = (bytehash.span_hashes(buffer, a, b, LOWER_BYTES) >> np.uint64(32)).astype("<u4")
                out = []
                for x in batch.column(3)[i].as_py():
                    # Another text of the same id may be too short.
                    if x["end"] <= len(words):
                        first = max(0, x["start"] - how.margin)
                        out.append((x["chain"], x["mine"], doc_id, tie, first, x["start"] - first, x["end"] - first, x["straight"],
                                    words[first:x["end"] + how.margin].tobytes()))
                yield _batch(out, SLICES)

    # Lists grow with the documents, so they are not broadcast where they happen to be few.
    return lists.hint("merge").join(rows, "key").select("doc_id", "tie", "text", "asked").mapInArrow(cut, SLICES)


def repeated_passages(docs: DataFrame, how: Passage = Passage()) -> DataFrame:
    """The passages of every document of ``docs`` (doc_id, text) that an earlier one has too.

    doc_id, tie (a hash of the row's text), start_word and end_word (words of the whole text,
    counted from 0), n_words, from_doc (the earliest document that was found to have it) and
    same_words. Overlapping passages are one. Null and short texts have none. Rows with a null id are
    documents of their own, known by a hash of their text. Rows with the same id are one document: their
    texts are not compared with each other. ``docs`` must give the same rows in the same order whenever
    a task reads them again, as a stored table does.
    """
    doc_id, tie = F.col("doc_id").cast("bigint"), F.xxhash64("text")
    rows = docs.select(F.coalesce(doc_id, tie).alias("key"), doc_id.alias("doc_id"), tie.alias("tie"), "text")

    def side(mine: str, *names: str):
        return F.max(F.when(F.expr(mine), F.struct(*names)))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in range(10)]
            for doc, tie_, first, xa, xb, straight, a, to, pa_, b in zip(*columns):
                a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
                out += [(doc, tie_, first + start, first + end, to, same) for start, end, same in passages_of(a, b, (xa, xb, pa_, 0), straight, how)]
            yield _batch(out, ALIGNED)

    with staging_folder(docs.sparkSession) as staged:
        found = kept(chained(rows, how).withColumn("chain", F.monotonically_increasing_id()), staged)
        pairs = _slices(rows, found, how).groupBy("chain").agg(
            side("mine", "doc_id", "tie", "first", "start", "end", "straight", "words").alias("a"),
            side("not mine", "doc_id", "start", "end", "words").alias("b")).where("a is not null and b is not null")
        spans = kept(_flat(pairs).mapInArrow(aligned, ALIGNED))
    # As many spans as a document has chains, which its own length bounds.
    lists = spans.groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set(F.struct("start_word", "end_word", "from_doc", "same_words"))).alias("spans"))
    return lists.mapInArrow(_merged, MERGED)


def _flat(pairs: DataFrame) -> DataFrame:
    return pairs.select("a.doc_id", "a.tie", "a.first", F.col("a.start").alias("xa"), F.col("a.end").alias("xb"), "a.straight",
                        F.col("a.words").alias("a_words"), F.col("b.doc_id").alias("to_doc"), F.col("b.start").alias("pa"), F.col("b.words").alias("b_words"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each document with overlapping ones made one."""
    for batch in batches:
        out = []
        for doc, tie_, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for x in items:
                a, b, to, same = x["start_word"], x["end_word"], x["from_doc"], x["same_words"]
                if out and out[-1][:2] == [doc, tie_] and a < out[-1][3]:
                    last = out[-1]
                    # What the overlap holds is counted once.
                    last[6] = min(max(last[3], b) - last[2], last[6] + max(0, same - max(0, min(last[3], b) - a)))
                    last[3] = max(last[3], b)
                    last[5] = to if last[5] is None else last[5] if to is None else min(to, last[5])
                    last[4] = last[3] - last[2]
                else:
                    out.append([doc, tie_, a, b, b - a, to, same])
        yield _batch([tuple(r) for r in out], MERGED)


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` (with doc_id, text, n_chars) less the words of their ``passages``, the white space after
    each one included; n_chars is that of the new text. Documents without other words go; those without
    passages stay as they are, null and empty ones too."""
    spans = passages.groupBy(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).agg(
        F.array_sort(F.collect_list(F.struct("start_word", "end_word"))).alias("__spans"))
    joined = docs.join(spans.hint("merge"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__tie")), "left").drop("__id", "__tie")
    schema = docs.schema
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_, texts, keep = batch.column(batch.num_columns - 1), [], []
            for i in range(batch.num_rows):
                items = spans_[i].as_py()
                if items is None:
                    texts.append(batch.column(place)[i].as_py())
                    keep.append(True)
                    continue
                raw = batch.column(place)[i].as_py().encode()
                buffer, offsets = bytehash.text_buffer(batch.column(place).slice(i, 1))
                begin, _, _ = bytehash.word_spans(buffer, offsets)
                begin = np.append(begin, len(raw))
                at, parts = 0, []
                for x in items:
                    parts.append(raw[at:begin[x["start_word"]]])
                    at = int(begin[x["end_word"]])
                text = b"".join([*parts, raw[at:]]).decode()
                texts.append(text)
                keep.append(bool(text.strip(" \t\n\v\f\r")))
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keep)], names=[*batch.schema.names[:-1], "__keep"])

    out = joined.withColumn("__cut", F.col("__spans").isNotNull())
    out = out.select(*[F.col(f"`{c}`") for c in docs.columns], "__cut", "__spans")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    out = out.mapInArrow(cut, f"{types}, __cut boolean, __keep boolean").where("__keep")
    return out.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(*[F.col(f"`{c}`") for c in docs.columns])
