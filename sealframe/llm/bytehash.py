"""64-bit hashes of words in Arrow text buffers, vectorised over all bytes of a batch."""

from __future__ import annotations

import numpy as np

# Fixed odd multipliers and shifts of a well-known 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
MIX = ((31, 0xBF58476D1CE4E5B9), (29, 0x94D049BB133111EB))

_U = np.uint64
# What each byte counts as.
BYTES = np.arange(256, dtype=np.uint8)
# Bytes of a span that are hashed one eight after the other; longer ones are hashed as the hashes of their blocks.
BLOCK = 128


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    for shift, factor in MIX:
        h = (h ^ (h >> _U(shift))) * _U(factor)
    return h ^ (h >> _U(32))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column; nulls are empty."""
    column = column.fill_null("").cast("large_string")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column, size: int = 4 << 20):
    """Parts of an Arrow string column with some ``size`` bytes of text each, as (first row, part).

    A row is never cut, so a part is at most ``size`` and the longest text.
    """
    _, offsets = text_buffer(column)
    if len(column):
        cuts = np.flatnonzero(np.diff(offsets[:-1] // size)) + 1
        edges = [0, *cuts.tolist(), len(column)]
        for a, b in zip(edges, edges[1:]):
            yield a, column.slice(a, b - a)


def span_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    """A hash of the bytes from each start to its end, wherever they stand, each taken for what ``table`` says."""
    data = buffer if table is BYTES else table[buffer]
    size = end - start
    # The length enters first.
    found = mix(size.astype(_U) + _U(BASE))
    long = np.flatnonzero(size > BLOCK)
    if len(long):
        blocks = -(-size[long] // BLOCK)
        ends = np.cumsum(blocks)
        first = np.repeat(start[long], blocks) + BLOCK * (np.arange(ends[-1]) - np.repeat(ends - blocks, blocks))
        parts = span_hashes(data, first, np.minimum(first + BLOCK, np.repeat(end[long], blocks)))
        found[long] = mix(found[long] ^ span_hashes(parts.view(np.uint8), 8 * (ends - blocks), 8 * ends))
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eights = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # those that begin at each byte
    at, done = np.flatnonzero((size > 0) & (size <= BLOCK)), 0
    while len(at):
        rest = np.minimum(size[at] - done, 8)
        # Nothing of what comes after the span.
        kept = eights[start[at] + done] << (8 * (8 - rest)).astype(_U)
        found[at] = mix(found[at] ^ kept)
        done += 8
        at = at[size[at] > done]
    return found


# Words are separated by space and the control characters from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_spans(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    inside = ~SPACE[buffer]
    texts = np.diff(offsets) > 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # Words do not run from one text into the next.
    first, last = offsets[:-1][texts], offsets[1:][texts] - 1
    begins[first], ends[last] = inside[first], inside[last]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, "right") - 1


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row, by the first; the last ``size`` - 1 are of no use."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, _U)
    for j in range(size):
        total += words[j:j + n] * _U(pow(MIX[1][1], 2 * j + 1, 1 << 64))
    return mix(total)


def distinct_per_text(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """How many different hashes each text has."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[new], minlength=texts)
