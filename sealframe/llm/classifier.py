"""A quality classifier: gradient-boosted trees over histograms of document statistics.

The statistics are computed once per document, vectorised over the bytes of a batch. The trees are
fitted on a bounded sample of labelled rows and flattened into arrays that numpy walks for all rows
and trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sealframe.llm import bytehash

FEATURES = ["bytes", "words", "lines", "bytes_per_word", "words_per_line", "upper", "digits", "ascii_letters", "non_ascii",
            "marks", "symbols", "exclamations", "bars", "periods", "commas", "spaces", "distinct_words", "distinct_windows",
            "distinct_lines", "longest_word"]


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(chars)] = 1
    return table


_ASCII = bytes(range(0x21, 0x7F))
_CLASSES = {
    "upper": _class(bytes(range(0x41, 0x5B))), "digits": _class(b"0123456789"),
    "ascii_letters": _class(bytes(c for c in _ASCII if chr(c).isalpha())), "non_ascii": _class(bytes(range(0x80, 0x100))),
    "marks": _class(bytes(c for c in _ASCII if not chr(c).isalnum())), "symbols": _class(b"#*$%&<>@^~={}[]\\_+"),
    "exclamations": _class(b"!?"), "bars": _class(b"|"), "periods": _class(b"."), "commas": _class(b",;:"), "spaces": _class(b" \t"),
}


def statistics(column) -> np.ndarray:
    """One row of FEATURES per text of an Arrow column; a null is an empty text. Shares are per byte,
    word, window or line, with at least one of them, so an empty text has zeros."""
    buffer, offsets = bytehash.text_buffer(column)
    texts = len(offsets) - 1
    size = np.diff(offsets)
    per = np.maximum(size, 1)
    found = {"bytes": size}
    for name, table in _CLASSES.items():
        sums = np.concatenate([[0], np.cumsum(table[buffer])])
        found[name] = (sums[offsets[1:]] - sums[offsets[:-1]]) / per

    start, end, owner = bytehash.word_spans(buffer, offsets)
    hashes = bytehash.span_hashes(buffer, start, end)
    words = np.bincount(owner, minlength=texts)
    found["words"] = words
    found["bytes_per_word"] = np.bincount(owner, weights=end - start, minlength=texts) / np.maximum(words, 1)
    found["distinct_words"] = bytehash.distinct_per_text(owner, hashes, texts) / np.maximum(words, 1)
    longest = np.zeros(texts)
    np.maximum.at(longest, owner, end - start)
    found["longest_word"] = longest
    windows = bytehash.window_hashes(hashes, 3)
    whole = owner[:len(windows)] == owner[2:] if len(windows) else np.zeros(0, bool)
    found["distinct_windows"] = bytehash.distinct_per_text(owner[:len(windows)][whole], windows[whole], texts) / np.maximum(words - 2, 1)

    breaks = buffer == 0x0A
    line_start = np.zeros(len(buffer), bool)
    line_start[offsets[:-1][size > 0]] = True
    line_start[1:] |= breaks[:-1]
    at = np.flatnonzero(line_start)
    line_owner = np.searchsorted(offsets, at, "right") - 1
    lines = np.bincount(line_owner, minlength=texts)
    stop = np.minimum(np.append(at[1:], len(buffer)), offsets[line_owner + 1]) if len(at) else at
    found["lines"] = lines
    found["words_per_line"] = words / np.maximum(lines, 1)
    found["distinct_lines"] = bytehash.distinct_per_text(line_owner, bytehash.span_hashes(buffer, at, stop), texts) / np.maximum(lines, 1)
    return np.stack([found[name] for name in FEATURES], axis=1).astype(np.float64)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``stats``, an array of FEATURES, of each row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in bytehash.slices(batch.column(1)):
                values = statistics(part)
                edges = np.arange(len(values) + 1, dtype=np.int32) * len(FEATURES)
                stats = pa.ListArray.from_arrays(pa.array(edges), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), stats], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, stats array<double>")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the CRC-32 of the id as text is divisible by ``folds``; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


SPREAD = 1 << 40  # of the hash by which the sample is drawn


@dataclass(frozen=True)
class Fit:
    """``sample``: labelled rows that the trees are fitted on at most, chosen by a hash of their id."""

    sample: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.2
    penalty: float = 1.0
    least: float = 1.0  # sum of second derivatives in a leaf


@dataclass
class Trees:
    """Complete binary trees: node i has children 2 i + 1 and 2 i + 2, the last level holds values."""

    base: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray  # right if above
    values: np.ndarray  # trees x leaves

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The chance of label 1 of each row, for all trees a level at a time."""
        trees = np.arange(len(self.features))
        at = np.zeros((len(rows), len(trees)), np.int64)
        inner = self.features.shape[1] if len(trees) else 0
        for _ in range(inner.bit_length()):
            value = np.take_along_axis(rows, self.features[trees, at], axis=1)
            at = 2 * at + 1 + (value > self.cuts[trees, at])
        raw = self.base + self.values[trees, at - inner].sum(axis=1) if len(trees) else np.full(len(rows), self.base)
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(rows: np.ndarray, labels: np.ndarray, how: Fit = Fit()) -> Trees:
    """Boosting on the logistic loss. Without both labels there are no trees, only the share of ones."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    base, inner, leaves = float(np.log(share / (1 - share))), 2 ** how.depth - 1, 2 ** how.depth
    none = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(np.unique(labels)) < 2:
        return none
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, how.bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    raw, n, features = np.full(len(rows), base), len(rows), rows.shape[1]
    all_features, all_cuts, all_values = [], [], []
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - labels, p * (1 - p)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(how.depth):
            width, first = 2 ** level, 2 ** level - 1
            best = np.zeros(width)
            for f in range(features):
                key = (at - first) * how.bins + binned[:, f]
                g = np.bincount(key, grad, width * how.bins).reshape(width, -1).cumsum(axis=1)
                h = np.bincount(key, hess, width * how.bins).reshape(width, -1).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = (g ** 2 / (h + how.penalty) + (gt - g) ** 2 / (ht - h + how.penalty) - gt ** 2 / (ht + how.penalty))
                gain[(h < how.least) | (ht - h < how.least)] = 0
                gain[:, len(edges[f]):] = 0
                to = gain.argmax(axis=1)
                better = gain[np.arange(width), to] > best + 1e-12
                for node in np.flatnonzero(better):
                    best[node] = gain[node, to[node]]
                    feature[first + node], cut[first + node] = f, edges[f][to[node]]
            at = 2 * at + 1 + (rows[np.arange(n), feature[at]] > cut[at])
        leaf = at - inner
        value = -how.rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + how.penalty)
        raw = raw + value[leaf]
        all_features.append(feature)
        all_cuts.append(cut)
        all_values.append(value)
    return Trees(base, np.array(all_features), np.array(all_cuts), np.array(all_values))


def trained(stats: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Trees:
    """Trees for ``labels`` (doc_id, quality) outside the held-out fold.

    At most ``how.sample`` rows with their statistics come to the driver. Null labels and ids take no
    part; contradicting labels of a document count as 0.
    """
    turn = F.xxhash64("doc_id").bitwiseAND(F.lit(SPREAD - 1))
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")) \
        .agg(F.min("quality").alias("quality")).withColumn("turn", turn)
    # Few more rows than the sample come into the sort, so that tasks do not each send one to the driver.
    among = min(SPREAD, int(SPREAD * (1.2 * how.sample + 200) / max(1, known.count())) + 1)
    rows = stats.join(known.where(F.col("turn") < among), "doc_id").orderBy("turn", "doc_id").limit(how.sample).select("stats", "quality").collect()
    return fit(np.array([r["stats"] for r in rows]).reshape(-1, len(FEATURES)), np.array([float(r["quality"] > 0) for r in rows]), how)


def scored(stats: DataFrame, trees: Trees, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; equal texts have equal scores."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.score(rows))], names=["doc_id", "score"])

    found = stats.mapInArrow(run, "doc_id bigint, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))
