"""Token ids of whole texts, as little-endian unsigned 32-bit integers.

The tokenizers library splits a text into pieces before it looks for tokens. Where a single space
stands between two letters, digits or marks from the ranges below, no piece reaches across it, so
the parts of a text can be encoded on their own and repeated ones only once. A text with the content
of an added token is one part, as the tokenizer looks for those before it splits. The result is that
of the whole text. Parts are told apart by their bytes; hashes only find those met before.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from sealframe.llm.bytehash import slices, span_hashes, text_buffer

# A part ends before a space between two of these: printable ASCII and the Latin letters U+00C0 to
# U+017F. None is white space, combines with a neighbour or changes case by it. A part also ends
# between an ASCII letter and an ASCII mark, where every piece ends too.
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True
LATIN_LEAD = np.zeros(256, bool)
LATIN_LEAD[0xC3:0xC6] = True
LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
MARK = PRINTABLE & ~LETTER & ~DIGIT
# Different parts that one Python worker remembers, and the longest in bytes.
REMEMBERED, LONGEST = 3_000_000, 64

_encoders: dict[str, Encoder] = {}


def parts(buffer: np.ndarray, offsets: np.ndarray, uncut: np.ndarray) -> np.ndarray:
    """Where the parts of all texts start; a part ends where the next one or its text does. The texts
    with the numbers ``uncut`` are one part each."""
    edge = np.zeros(len(buffer) + 1, bool)
    edge[offsets] = True
    begins = np.zeros(len(buffer), bool)
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(buffer == 0x20)
    at = at[~edge[at] & ~edge[at + 1]]
    before = PRINTABLE[buffer[at - 1]] | (~edge[at - 1] & (buffer[at - 1] >= 0x80) & LATIN_LEAD[buffer[at - 2]])
    begins[at[before & (PRINTABLE | LATIN_LEAD)[buffer[at + 1]]]] = True
    if len(buffer):
        begins[1:] |= LETTER[buffer[:-1]] & MARK[buffer[1:]]
    for t in uncut.tolist():
        begins[offsets[t] + 1:offsets[t + 1]] = False
    return np.flatnonzero(begins)


def _added(tokenizer) -> re.Pattern[bytes] | None:
    """The contents of a tokenizer's added tokens; those that are looked for in the normalized text in
    any case and also as they are normalized."""
    found = set()
    for token in tokenizer.get_added_tokens_decoder().values():
        if token.normalized and tokenizer.normalizer:
            found |= {f"(?i:{re.escape(c)})" for c in (token.content, tokenizer.normalizer.normalize_str(token.content)) if c}
        elif token.content:
            found.add(re.escape(token.content))
    return re.compile("|".join(sorted(found)).encode()) if found else None


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = _added(self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted; of each part its ids and its bytes
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.bytes_at, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, "<u4"), 0
        self.bytes = np.zeros(0, np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for i in range(0, len(texts), 8192)
                 for e in self.tokenizer.encode_batch_fast(texts[i:i + 8192], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter(chain.from_iterable(found), "<u4", int(lengths.sum())), lengths

    def uncut(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """The numbers of the texts that may hold an added token."""
        found = [m.span() for m in self.added.finditer(raw)] if self.added else []
        # A hit over a text's end is none, but could hide one in either text.
        ends = np.array([(a, b - 1) for a, b in found], np.int64).ravel()
        return np.unique(np.searchsorted(offsets, ends, "right") - 1)

    def ids(self, column, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow column of texts, each followed by ``end``, and the texts' offsets in them."""
        buffer, offsets = text_buffer(column)
        raw = buffer.tobytes()
        start = parts(buffer, offsets, self.uncut(raw, offsets))
        owner = np.searchsorted(offsets, start, "right") - 1
        stop = np.minimum(np.append(start[1:], len(buffer)), offsets[owner + 1]) if len(start) else start
        # The parts cover all texts, so they are a column of their own; different ones are told apart by their bytes.
        edges = pa.py_buffer(np.append(start, len(buffer)).astype(np.int64))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, edges, pa.py_buffer(raw)]).dictionary_encode()
        back = coded.indices.to_numpy()
        text, ends = text_buffer(coded.dictionary.view(pa.large_string()))
        at, size = ends[:-1], np.diff(ends)
        hashes = span_hashes(text, at, ends[1:])

        begin, count = np.zeros(len(at), np.int64), np.zeros(len(at), np.int32)
        known = np.zeros(len(at), bool)
        if len(self.hashes) and len(at):
            place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = (self.hashes[place] == hashes) & (self.sizes[place] == size)
            maybe = np.flatnonzero(known)
            known[maybe] = same_bytes(text, at[maybe], self.bytes, self.bytes_at[place[maybe]], size[maybe])
            begin[known], count[known] = self.starts[place[known]], self.lengths[place[known]]
        # Long parts are seldom met again: they come last, and their ids end with this batch's.
        new = np.flatnonzero(~known)
        long = size[new] > LONGEST
        keep = new[~long]
        new = np.concatenate([keep, new[long]])
        whole = text.tobytes()
        fresh, lengths = self.encode([whole[a:b].decode() for a, b in zip(at[new].tolist(), ends[1:][new].tolist())])
        begin[new], count[new] = self.used + np.cumsum(lengths) - lengths, lengths
        while self.used + len(fresh) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), "<u4")])
        self.flat[self.used:self.used + len(fresh)] = fresh

        # Every part's ids in text order, with room for each text's end id.
        sizes = count[back]
        per_text = np.bincount(owner, weights=sizes, minlength=len(offsets) - 1).astype(np.int64) + 1
        out_offsets = np.concatenate([[0], np.cumsum(per_text)])
        target = np.full(out_offsets[-1], end, "<u4")
        place = np.ones(out_offsets[-1], bool)
        place[out_offsets[1:] - 1] = False
        shift = np.cumsum(sizes) - sizes
        target[place] = self.flat[np.repeat(begin[back] - shift, sizes) + np.arange(int(sizes.sum()))]

        if len(self.hashes) + len(keep) > REMEMBERED:
            self.forget()
        elif len(keep):
            self.used += int(lengths[:len(keep)].sum())
            hashes = np.concatenate([self.hashes, hashes[keep]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.starts = np.concatenate([self.starts, begin[keep]])[order]
            self.lengths = np.concatenate([self.lengths, count[keep]])[order]
            sizes = size[keep]
            self.bytes_at = np.concatenate([self.bytes_at, len(self.bytes) + np.cumsum(sizes) - sizes])[order]
            self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])[order]
            self.bytes = np.concatenate([self.bytes, text[spread(at[keep], sizes)]])
        return target, out_offsets


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of spans, one span after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def same_bytes(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of equal sizes, none of them empty, hold the same bytes."""
    if not len(size):
        return np.zeros(0, bool)
    differ = a[spread(a_start, size)] != b[spread(b_start, size)]
    return np.add.reduceat(differ, np.cumsum(size) - size, dtype=np.int64) == 0


def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def document_ids(column, path: str, end: int):
    """The ids of each text of an Arrow column in order, in memory for a few MB of text at a time."""
    found = encoder(path)
    for _, some in slices(column):
        ids, offsets = found.ids(some, end)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            yield ids[a:b]
