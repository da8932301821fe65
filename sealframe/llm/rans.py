"""Static range asymmetric numeral system over integer symbols, many lanes in lock step (numpy).

A frame holds one frequency table and several blocks that are decoded independently of each other.
A block deals its symbols round robin to LANES states; all lanes share one stream of 32-bit words.
Every CHECKPOINT symbols the decoder's states and place in the stream are noted, so decoding can also
start there. Each block carries the CRC-32 of its symbols.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

LANES = 1024
BLOCK = 1 << 20
CHECKPOINT = 1 << 18
LOW = np.uint64(1 << 31)  # a state stays in [2 ** 31, 2 ** 63)
WORD = np.uint64(32)
# Symbols below this are counted and looked up in arrays, larger ones by sorting.
DIRECT = 1 << 22


@dataclass
class Table:
    """Symbols in ascending order with frequencies that sum to 2 ** bits."""

    symbols: np.ndarray
    frequencies: np.ndarray
    bits: int

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        """From counts; every symbol keeps a frequency of at least 1."""
        if len(ids) and ids.max() < DIRECT:
            counts = np.bincount(ids)
            symbols = np.flatnonzero(counts)
            counts = counts[symbols]
        else:
            symbols, counts = np.unique(ids, return_counts=True)
        bits = min(max(len(symbols).bit_length() + 3, 12), 28)
        whole = 1 << bits
        freq = np.maximum(1, counts * whole // max(1, int(counts.sum()))).astype(np.int64)
        # What rounding left or took goes to or comes from the most frequent ones, in proportion.
        order = np.argsort(-freq, kind="stable")
        rest = whole - int(freq.sum())
        if rest > 0 and len(freq):
            freq[order[0]] += rest
        while rest < 0:
            spare = np.minimum(freq[order] - 1, np.maximum(1, freq[order] // 8))
            take = np.minimum(spare, np.maximum(0, -rest - (np.cumsum(spare) - spare)))
            freq[order] -= take
            rest += int(take.sum())
        return cls(symbols.astype("<u4"), freq.astype("<u4"), bits)

    def pack(self) -> bytes:
        gaps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        return zlib.compress(np.concatenate([np.array([self.bits, len(gaps)], "<u4"), gaps, self.frequencies]).tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        a = np.frombuffer(zlib.decompress(data), "<u4")
        n = int(a[1])
        return cls(np.cumsum(a[2:2 + n], dtype="<u4"), a[2 + n:2 + 2 * n], int(a[0]))


@dataclass
class Block:
    """``states`` and ``places``: of the decoder at its start and at every checkpoint."""

    count: int
    crc: int
    states: np.ndarray
    places: np.ndarray
    words: np.ndarray


def encode(ids: np.ndarray, table: Table) -> Block:
    freq = table.frequencies.astype(np.uint64)
    cum = np.cumsum(freq) - freq
    if len(table.symbols) and table.symbols[-1] < DIRECT:
        place = np.zeros(int(table.symbols[-1]) + 1, np.int32)
        place[table.symbols] = np.arange(len(table.symbols))
        index = place[ids]
    else:
        index = np.searchsorted(table.symbols, ids)
    bits, bound = np.uint64(table.bits), freq << np.uint64(63 - table.bits)
    x = np.full(LANES, LOW, np.uint64)
    steps, every = -(-len(ids) // LANES), CHECKPOINT // LANES
    words, states, after, written = [], [], [], 0
    for step in range(steps - 1, -1, -1):
        at = index[step * LANES:(step + 1) * LANES]
        y, f = x[:len(at)], freq[at]
        full = y >= bound[at]
        if full.any():
            # In reverse, so that the reversed stream has the words in lane order.
            words.append(y[full][::-1].astype("<u4"))
            written += len(words[-1])
            y = np.where(full, y >> WORD, y)
        q = y // f
        x[:len(at)] = (q << bits) + (y - q * f) + cum[at]
        if step % every == 0:
            states.append(x.copy())
            after.append(written)
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, "<u4")
    return Block(len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")),
                 np.array(states[::-1], "<u8").reshape(-1, LANES), written - np.array(after[::-1], "<i8"), stream)


def decode(block: Block, table: Table, since: int = 0) -> np.ndarray:
    """The symbols from checkpoint ``since`` on. A whole block is held against its checksum."""
    freq = table.frequencies.astype(np.uint64)
    cum = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(len(freq), dtype=np.int32), table.frequencies)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    first = since * CHECKPOINT
    out = np.zeros(max(0, block.count - first), np.int32)
    if len(out):
        x, place = block.states[since].astype(np.uint64), int(block.places[since])
    for a in range(0, len(out), LANES):
        n = min(LANES, len(out) - a)
        y = x[:n]
        low = y & mask
        at = slots[low]
        out[a:a + n] = at
        y = freq[at] * (y >> bits) + low - cum[at]
        short = np.flatnonzero(y < LOW)
        if len(short):
            y[short] = (y[short] << WORD) | block.words[place:place + len(short)]
            place += len(short)
        x[:n] = y
    ids = table.symbols[out] if len(out) else np.zeros(0, "<u4")
    if since == 0 and zlib.crc32(np.ascontiguousarray(ids, "<u4")) != block.crc:
        raise ValueError("a block does not have the checksum that it was written with")
    return ids
