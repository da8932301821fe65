"""Phrases whose words belong together, from counts kept as sorted streams.

1. Counting. Texts become batches of word numbers, written once. Round by round phrases of one word more are looked at, only
   where both shorter ones within may be frequent: a batch sends the hash and count of each, a bucket answers with a bit
   for each, and only what is frequent in the whole corpus goes on. Hashes decide what is looked at further, never a
   result: what is left is counted by its words.
2. Streams. The counts of all lengths are laid out in prefix order (sorted from the first word) and in suffix order (from
   the last), over ranges of equal size whatever the words are. One pass over a sorted range holds a path of at most as
   many phrases as the longest has words, and merges the lengths in lockstep: a phrase meets the counts of all phrases
   that it starts with and tells its own to the one that it extends. The suffix order gives the same for endings. Where a
   range begins within a path, the few phrases above are looked up afterwards.
3. Both streams meet, phrase by phrase, and give every cut its score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sealframe.llm.bytehash import mix, slices, text_buffer
from sealframe.llm.shared import kept, partitions
from sealframe.session import staging_folder

# Bytes of text of a batch, about, and of what a bucket gathers in one round.
FLUSH, BUCKET = 16 << 20, 32 << 20
# What is lower-cased, what ends a piece and what parts words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)], KIND[list(BREAKS)] = 1, 2


@dataclass(frozen=True)
class Rules:
    """Phrases of 2 to ``longest`` words with at least ``least`` occurrences; one is dropped if a longer one has
    ``covered`` percent of its occurrences; the ``best`` of each language are returned."""

    longest: int = 5
    least: int = 100
    covered: int = 100
    best: int = 2000


# A batch of one language: its words, the number of every word in text order, how many words the piece has from
# there on (``longest`` at most), and whether the phrase that was last looked at there may be frequent. Or phrases of a
# batch, their words parted by spaces, with their counts: those of one bucket.
BATCH = "key bigint, lang string, dictionary array<string>, ids binary, room binary, live binary, bucket int, phrases array<string>, counts array<bigint>"
ENTRIES = "bucket int, key bigint, hashes binary, counts binary"
ANSWERS = "key bigint, bucket int, bits binary"
KINDS = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("dictionary", pa.list_(pa.string())), ("ids", pa.binary()), ("room", pa.binary()),
                   ("live", pa.binary()), ("bucket", pa.int32()), ("phrases", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


@dataclass
class Batch:
    key: int
    lang: str
    dictionary: pa.Array
    ids: np.ndarray
    room: np.ndarray
    live: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Batch:
        return cls(row["key"], row["lang"], row["dictionary"], *(np.frombuffer(row[c], t) for c, t in (("ids", "<i4"), ("room", "u1"), ("live", "u1"))))

    def row(self) -> pa.RecordBatch:
        full = [[self.key], [self.lang], None, [self.ids.astype("<i4").tobytes()], [self.room.tobytes()], [self.live.astype("u1").tobytes()], [None], [None], [None]]
        arrays = [None if c is None else pa.array(c, f.type) for c, f in zip(full, KINDS)]
        arrays[2] = pa.ListArray.from_arrays(pa.array([0, len(self.dictionary)], pa.int32()), self.dictionary)
        return pa.RecordBatch.from_arrays(arrays, schema=KINDS)

    def places(self, size: int) -> np.ndarray:
        """Where phrases of ``size`` words start that may be frequent, as the two within them may be."""
        if size == 1:
            return np.arange(len(self.ids))
        at = np.flatnonzero(self.room >= size)
        return at if size == 2 else at[(self.live[at] & self.live[at + 1]) > 0]

    def hashes(self, sizes: tuple[int, ...]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Places and hashes of the phrases of each size."""
        own = np.array(list(map(xxhash.xxh64_intdigest, self.dictionary.cast(pa.binary()).to_pylist())), np.uint64)
        seed = xxhash.xxh64_intdigest(self.lang.encode()) >> 1
        places, found = [], []
        for size in sizes:
            at = self.places(size)
            h = np.full(len(at), seed + size, np.uint64)
            for j in range(size):
                h = mix(h ^ own[self.ids[at + j]]) + np.uint64(j)
            places.append(at)
            found.append(h)
        return places, found

    def counts(self, size: int, at: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
        """How often each phrase starts at these places, by the buckets of their hashes; told apart by its words."""
        key = self.ids[at].astype(np.int64)
        for j in range(1, size):
            if j > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self.dictionary) + self.ids[at + j]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        order = np.argsort(hashes[first], kind="stable")
        first, n = first[order], n[order]
        words = self.dictionary.take(pa.array(self.ids[at[first][:, None] + np.arange(size)].ravel()))
        phrases = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * size, pa.int32()), words), " ")
        cuts = _edges(hashes[first], buckets)
        full = np.flatnonzero(np.diff(cuts))
        return counted(self.lang, full, np.append(cuts[full], len(n)), phrases, n)

    def narrowed(self, size: int, live: np.ndarray) -> Batch:
        """Only words of phrases of ``size`` words that start at a live place."""
        keep = np.zeros(len(self.ids), bool)
        for j in range(size):
            keep[live + j] = True
        flags = np.zeros(len(self.ids), np.uint8)
        flags[live] = 1
        at = np.flatnonzero(keep)
        last = np.ones(len(at), bool)
        last[:-1] = (np.diff(at) > 1) | (self.room[at[:-1]] == 1)
        used, ids = np.unique(self.ids[at], return_inverse=True)
        return Batch(self.key, self.lang, self.dictionary.take(pa.array(used)), ids.astype(np.int32), _room(last, int(self.room.max(initial=1))), flags[at])


def _room(last: np.ndarray, most: int) -> np.ndarray:
    """How many words there are up to the next one marked as last, itself included."""
    ends = np.flatnonzero(last)
    at = np.arange(len(last))
    return np.minimum(ends[np.searchsorted(ends, at)] - at + 1, most).astype(np.uint8) if len(last) else np.zeros(0, np.uint8)


def counted(lang: str, buckets: np.ndarray, offsets: np.ndarray, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    rows, ends = len(buckets), pa.array(offsets, pa.int32())
    return pa.RecordBatch.from_arrays([pa.nulls(rows, pa.int64()), pa.array([lang] * rows, pa.string()), *[pa.nulls(rows, f.type) for f in list(KINDS)[2:6]], pa.array(buckets, pa.int32()),
                                       pa.ListArray.from_arrays(ends, phrases), pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))], schema=KINDS)


def words_of(texts: list[bytes], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of some texts, the number of every word in order, and the room from there on."""
    buffer = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = KIND[buffer]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    last = np.ones(len(start), bool)
    last[:-1] = piece[1:] != piece[:-1]
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(buffer[inside])).dictionary_encode()
    return words.dictionary.cast(pa.string()), words.indices.to_numpy(), _room(last, longest)


def _batches(docs: DataFrame, rules: Rules) -> DataFrame:
    most = FLUSH

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang, texts in held.items():
                dictionary, ids, room = words_of(texts, rules.longest)
                if len(ids):
                    yield Batch(number, lang, dictionary, ids, room, np.ones(len(ids), np.uint8)).row()
                    # The phrase without words is every word's beginning.
                    yield counted(lang, np.zeros(1, int), np.array([0, 1]), pa.array([""]), np.array([len(ids)]))
                    number += 1

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, part in slices(batch.column(1), most):
                buffer, offsets = text_buffer(part)
                raw = buffer.tobytes()
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    held.setdefault(langs[first + i], []).append(raw[a:b])
                size += len(raw)
                if size >= most:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), F.col("text").cast("string")).mapInArrow(cut, BATCH)


def _edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin in sorted hashes; buckets are ranges of them."""
    first = np.array([-(-(b << 64) // buckets) for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(hashes, first), len(hashes))


def _entries(batches: DataFrame, sizes: tuple[int, ...], buckets: int, least: int) -> DataFrame:
    # A capped count is still enough.
    kind = np.min_scalar_type(least)

    def sent(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read(rows):
            hashes, counts = np.unique(np.concatenate(batch.hashes(sizes)[1]), return_counts=True)
            cuts = _edges(hashes, buckets)
            full = np.flatnonzero(np.diff(cuts)).tolist()
            spans = [(cuts[b], cuts[b + 1]) for b in full]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array([batch.key] * len(full), pa.int64()), pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([np.minimum(counts[a:b], least).astype(kind).tobytes() for a, b in spans], pa.binary())], names=["bucket", "key", "hashes", "counts"])

    return batches.mapInArrow(sent, ENTRIES)


def _read(rows: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    for batch in rows:
        for i in range(batch.num_rows):
            yield _batch(batch.slice(i, 1))


def _batch(row: pa.RecordBatch | pa.Table) -> Batch:
    column = lambda c: row.column(c)[0]
    return Batch.of({c: column(c).as_py() for c in ("key", "lang", "ids", "room", "live")} | {"dictionary": column("dictionary").values})


def _answers(entries: DataFrame, least: int) -> DataFrame:
    def answered(table: pa.Table) -> pa.Table:
        raw = table.column("hashes").to_pylist()
        hashes = np.concatenate([np.frombuffer(x, "<u8") for x in raw])
        counts = np.concatenate([np.frombuffer(x, np.min_scalar_type(least)) for x in table.column("counts").to_pylist()])
        order = np.argsort(hashes, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        enough = np.add.reduceat(counts[order].astype(np.int64), edges) >= least
        bits = np.zeros(len(hashes), bool)
        bits[order] = np.repeat(enough, np.diff(np.append(edges, len(hashes))))
        ends = np.cumsum([len(x) // 8 for x in raw])
        return pa.table([table.column("key"), table.column("bucket"), pa.array([np.packbits(x).tobytes() for x in np.split(bits, ends[:-1])], pa.binary())], names=["key", "bucket", "bits"])

    return entries.groupBy("bucket").applyInArrow(answered, ANSWERS)


def _judged(batches: DataFrame, answers: DataFrame, sizes: tuple[int, ...], buckets: int, longest: int) -> DataFrame:
    """Counts of the phrases of these sizes that may be frequent, and the batches less all other places. After the round before the
    last, the counts of the longest phrases come too."""
    last = sizes[-1] == longest - 1

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            batch = _batch(left)
            places, found = batch.hashes(sizes)
            unique, back = np.unique(np.concatenate(found), return_inverse=True)
            cuts, good = _edges(unique, buckets), np.zeros(len(unique), bool)
            for bucket, bits in zip(right.column("a_bucket").to_pylist(), right.column("bits").to_pylist()):
                a, b = cuts[bucket], cuts[bucket + 1]
                good[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
            good = np.split(good[back], np.cumsum([len(p) for p in places])[:-1])
            places, found = [p[g] for p, g in zip(places, good)], [h[g] for h, g in zip(found, good)]
            out = [batch.counts(size, at, h, buckets) for size, at, h in zip(sizes, places, found) if len(at)]
            rest = batch.narrowed(sizes[-1], places[-1])
            if last and len(at := rest.places(longest)):
                out.append(rest.counts(longest, at, rest.hashes((longest,))[1][0], buckets))
            elif len(rest.ids) and not last:
                out.append(rest.row())
        return pa.Table.from_batches(out, schema=KINDS)

    right = answers.select(F.col("key").alias("a_key"), F.col("bucket").alias("a_bucket"), "bits")
    return batches.groupBy("key").cogroup(right.groupBy("a_key")).applyInArrow(judge, BATCH)


def phrase_counts(docs: DataFrame, rules: Rules, folder: str) -> DataFrame:
    """lang, words and f of every phrase of 1 to ``longest`` words with ``least`` occurrences or more; without words, those of all
    words of a language."""
    found = kept(_batches(docs, rules), folder)
    is_count = F.col("phrases").isNotNull()
    counts = [found.where(is_count)]
    words = counts[0].agg(F.coalesce(F.sum(F.col("counts")[0]), F.lit(0))).first()[0]
    # At most two hashes of eight bytes and their counts for every word.
    buckets = max(partitions(docs.sparkSession), -(-20 * words // BUCKET))
    for sizes in [(1, 2), *((m,) for m in range(3, rules.longest))] if rules.longest > 2 else [(1,)]:
        batches = found.where(~is_count)
        answers = _answers(_entries(batches, sizes, buckets, rules.least), rules.least)
        found = kept(_judged(batches, answers, sizes, buckets, rules.longest), folder)
        counts.append(found.where(is_count))
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return kept(_summed(every.select("bucket", "lang", "phrases", "counts"), rules.least), folder)


def _summed(counts: DataFrame, least: int) -> DataFrame:
    """The sums over all batches. A phrase is in one bucket, and a batch sends each bucket one row for a length."""
    def summed(table: pa.Table) -> pa.Table:
        phrases, n = (table.column(c).combine_chunks() for c in ("phrases", "counts"))
        langs = table.column("lang").combine_chunks().dictionary_encode().take(pc.list_parent_indices(phrases))
        sums = pa.table([langs, phrases.flatten(), n.flatten()], names=["lang", "phrase", "n"]).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        whole = pc.equal(sums.column("phrase"), "")
        sums = sums.filter(pc.or_(pc.greater_equal(sums.column("n_sum"), least), whole))
        return pa.table([sums.column("lang").cast(pa.string()), pc.split_pattern(sums.column("phrase"), " "), sums.column("n_sum")], names=["lang", "words", "f"])

    found = counts.groupBy("bucket").applyInArrow(summed, "lang string, words array<string>, f bigint")
    return found.withColumn("words", F.when(F.col("words")[0] == "", F.array().cast("array<string>")).otherwise(F.col("words")))


STREAM = "lang string, words array<string>, f bigint, above array<bigint>, most bigint"


def climb(rows: Iterator[tuple[str, list[str], int]]) -> Iterator[tuple[str, list[str], int | None, list[int | None], int]]:
    """Of phrases in order: each with its count, the counts of those it starts with (shortest first, none where they came before the
    first row) and the largest count of those that have one word more. Phrases that came before the first row are
    given too, without a count."""
    path: list[list] = []
    for lang, words, f in rows:
        while path and (path[-1][0] != lang or path[-1][1] != words[:len(path[-1][1])]):
            yield tuple(path.pop())
        while len(path) < len(words):
            path.append([lang, words[:len(path)], None, [p[2] for p in path], 0])
        if path:
            path[-1][4] = max(path[-1][4], f)
        path.append([lang, words, f, [p[2] for p in path], 0])
    while path:
        yield tuple(path.pop())


def _stream(grams: DataFrame, words, folder: str) -> DataFrame:
    """One order of the counts, climbed range by range."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, list[str], int]]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        held = []
        for row in climb(rows()):
            held.append(row)
            if len(held) == 4096:
                yield _arrow(held, STREAM_KINDS)
                held = []
        if held:
            yield _arrow(held, STREAM_KINDS)

    sorted_ = grams.select("lang", words.alias("words"), "f").repartitionByRange(partitions(grams.sparkSession), "lang", "words").sortWithinPartitions("lang", "words")
    return kept(sorted_.mapInArrow(merged, STREAM), folder)


STREAM_KINDS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("f", pa.int64()), ("above", pa.list_(pa.int64())), ("most", pa.int64())])
SCORED = "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
SCORED_KINDS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *[(c, pa.int64()) for c in ("a", "l", "r", "n", "score")]])


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _missing(stream: DataFrame) -> dict[tuple[str, tuple[str, ...]], tuple[int, int]]:
    """Count and largest count of an extension, from all ranges, of the phrases above the first rows of ranges: as many as the
    longest phrase has words, for each range at most."""
    above = stream.where("f IS NULL").groupBy("lang", "words").agg(F.max("most").alias("most"))
    found = stream.where("f IS NOT NULL").select("lang", "words", "f").join(F.broadcast(above), ["lang", "words"])
    return {(lang, tuple(words)): (f, most) for lang, words, f, most in found.select("lang", "words", "f", "most").collect()}


def best_cut(a: int, n: int, left: list[int], right: list[int]) -> tuple[int, int, int]:
    """Score, l and r of the cut with the lowest score, the first of equals."""
    score, k = min((1000 * a * n // (x * y), k) for k, (x, y) in enumerate(zip(left, right)))
    return score, left[k], right[k]


def collocations(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, rank from 1, phrase, a, l, r, n, score: the best phrases of each language, highest score first, then most
    frequent, then by the bytes of the phrase.

    Words are what stands between spaces and tabs in the pieces between punctuation and line ends; A to Z count as lower case.
    A null language is ``und``, a null text is empty. ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring
    cut, ``n`` all words of the language; the score is floor(1000 a n / (l r)), exact whatever the size. Other columns of
    ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    with staging_folder(spark) as folder:
        grams = phrase_counts(docs, rules, folder)
        forward, backward = _stream(grams, F.col("words"), folder), _stream(grams, F.reverse("words"), folder)
        gaps = _missing(forward), _missing(backward)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for lang, words, a, starts, most_after, ends, most_before in zip(*(c.to_pylist() for c in batch.columns)):
                    way = words, words[::-1]
                    parts = [[gaps[s][lang, tuple(way[s][:i])][0] if f is None else f for i, f in enumerate(above)] for s, above in enumerate((starts, ends))]
                    longer = max(most_after, most_before, *(gaps[s].get((lang, tuple(way[s])), (0, 0))[1] for s in (0, 1)))
                    if 100 * longer < rules.covered * a:
                        n, left, right = parts[0][0], parts[0][1:], parts[1][:0:-1]
                        rows.append((lang, " ".join(words), a, *best_cut(a, n, left, right)[1:], n, best_cut(a, n, left, right)[0]))
                if rows:
                    yield _arrow(rows, SCORED_KINDS)

        phrases = forward.where("f IS NOT NULL AND size(words) > 1")
        other = backward.where("f IS NOT NULL AND size(words) > 1").select("lang", F.reverse("words").alias("words"), F.col("above").alias("ends"), F.col("most").alias("most_before"))
        both = phrases.join(other, ["lang", "words"]).select("lang", "words", "f", "above", "most", "ends", "most_before")
        order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        ranked = both.mapInArrow(score, SCORED).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= rules.best)
        return kept(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
