"""Cells of many rows by one call of the cipher. For ``gcm`` the same tokens as ``tokens.seal``, for tables where its set-up is what a cell costs.

GCM enciphers counters, and combines what comes of it with the text and with a hash over the field of 2**128 elements (NIST SP 800-38D).
An Arrow function makes the counters of a batch, with a nonce of 96 random bits for each cell, Spark's ``aes_encrypt`` enciphers them
all at once (ECB), and another Arrow function combines. Texts and keys so reach the Python workers; no plan shows either.

Cells of ``cbc`` and ``fernet`` are one chain, as those of a row are in ``tokens.seal_chain``: here of many rows.
"""

from __future__ import annotations

import binascii
import hashlib
import os
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sealframe.functions.keys import KEY, key_parts
from sealframe.functions.text import cell
from sealframe.functions.tokens import AES_BLOCK, FERNET_OVERHEAD, FERNET_VERSION, GCM_OVERHEAD, IV_BYTES, MAC_BYTES
from sealframe.session import package_on_workers

# Bytes of a nonce and of a tag, and the field's polynomial x**128 + x**7 + x**2 + x + 1, its least power in the highest bit.
NONCE = 12
TAG = 16
POLYNOMIAL = 0xE1 << 120
# How URL-safe Base64 differs from the usual one, and its padding.
URL_SAFE = bytes.maketrans(b"+/", b"-_")
PAD = ord("=")
FROM_URL_SAFE = bytes.maketrans(b"-_=", b"+/A")
USUAL = r"\A[A-Za-z0-9_-]*={0,2}\z"
STANDARD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
# Cells and bytes of a call; a row is never cut.
CELLS, TEXT = 1 << 14, 1 << 21

_KEY = "__key"
_SEALED_WITH = f"{_KEY} binary, rows binary, nonces binary, blocks binary"


@dataclass(frozen=True)
class _Way:
    """What the cipher gets, from the cells of a batch and their key, with bytes to keep until then; its call; and what comes of that."""

    before: Callable[[_Flat, bytes], tuple[bytes, bytes | None]]
    cipher: Callable[[Column, Column], Column]
    after: Callable[[_Flat, bytes, bytes | None, bytes, int], pa.Array]
    # For tokens, whether they are only given to be checked; texts are sealed as they are.
    given: bool | None = None


def _counted(nonces: Callable, combined: Callable) -> _Way:
    def before(flat: _Flat, key: bytes) -> tuple[bytes, bytes]:
        own, sizes = nonces(flat)
        return own.tobytes(), _counters(own, -(-sizes // AES_BLOCK) + 1)

    def after(flat: _Flat, own: bytes, stream: bytes, key: bytes, clock: int) -> pa.Array:
        return combined(flat, np.frombuffer(own, np.uint8).reshape(-1, NONCE), np.frombuffer(stream, np.uint8).reshape(-1, AES_BLOCK))

    return _Way(before, lambda blocks, key: F.aes_encrypt(blocks, key, F.lit("ECB"), F.lit("PKCS")), after)


def _chained(method: str, call: Callable[..., Column], before: Callable, after: Callable) -> _Way:
    def cipher(blocks: Column, key: Column) -> Column:
        return call(blocks, F.substring(key, 17, 16) if method == "fernet" else key, F.lit("CBC"), F.lit("PKCS"))

    return _Way(lambda flat, key: (b"", before(flat, key, method)), cipher, lambda flat, own, stream, key, clock: after(flat, stream, key, clock, method))


def seal_batches(keyed: DataFrame, texts: dict[str, Column], others: list[str], method: str = "gcm") -> DataFrame:
    """A token for each of ``texts``, and the columns ``others``; ``keyed`` has the key of ``with_key``."""
    way = _counted(_nonces, _sealed) if method == "gcm" else _chained(method, F.aes_encrypt, _padded, _chain_sealed)
    after = way.after
    return _batches(keyed, texts, others, replace(way, after=lambda *found: _encoded(after(*found))), T.StringType())


def open_batches(keyed: DataFrame, tokens: dict[str, Column], others: list[str], method: str = "gcm") -> DataFrame:
    """The bytes of the text in each token; a wrong tag, MAC or pad fails the query."""
    way = _counted(_given, _opened) if method == "gcm" else _chained(method, F.aes_decrypt, _whole, _chain_opened)
    return _batches(keyed, tokens, others, replace(way, given=False), T.BinaryType())


def check_batches(keyed: DataFrame, tokens: dict[str, Column], method: str = "gcm") -> DataFrame:
    """Whether each token is intact, null for null. Never fails."""
    if method == "gcm":
        return _batches(keyed, tokens, [], replace(_counted(_given, _intact), given=True), T.BooleanType())
    package_on_workers(keyed.sparkSession)
    n, rows, names = len(tokens), _rows(keyed, tokens, [], "string"), list(tokens)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, batch in (found for b in batches for found in _cut(_raw(b, n, True), n)):
            flat = _Flat(batch.columns)
            intact = pa.array(_macs_match(flat, key), mask=~flat.valid.to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([intact.slice(i * batch.num_rows, batch.num_rows) for i in range(n)], names=names)

    return rows.mapInArrow(check, T.StructType([T.StructField(c, T.BooleanType()) for c in names]))


def _rows(keyed: DataFrame, cells: dict[str, Column], others: list[str], kind: str) -> DataFrame:
    # Functions take no columns with dots in their names.
    return keyed.select(F.col(KEY)["whole"].alias(_KEY), *[c.cast(kind).alias(name) for name, c in cells.items()], *[cell(c).alias(f"__other{i}") for i, c in enumerate(others)])


def _batches(keyed: DataFrame, cells: dict[str, Column], others: list[str], way: _Way, made: T.DataType) -> DataFrame:
    package_on_workers(keyed.sparkSession)
    before, after, given = way.before, way.after, way.given
    n, rows = len(cells), _rows(keyed, cells, others, "binary" if given is None else "string")
    names = rows.columns[1:]
    schema = T.StructType([T.StructField(f.name, made if i < n else f.dataType) for i, f in enumerate(rows.schema.fields[1:])])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, batch in (found for b in batches for found in _cut(b if given is None else _raw(b, n, given), n)):
            own, blocks = before(_Flat(batch.columns[:n]), key)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (key, _stored(batch), own, blocks)], names=[_KEY, "rows", "nonces", "blocks"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stored, own, stream, key, clock in ((x.as_py() for x in row) for b in batches for row in zip(*b.columns)):
            with pa.ipc.open_stream(stored) as file:
                batch = file.read_next_batch()
            cells = after(_Flat(batch.columns[:n]), own, stream, key, clock)
            yield pa.RecordBatch.from_arrays([*(cells.slice(i * batch.num_rows, batch.num_rows) for i in range(n)), *batch.columns[n:]], names=names)

    counted = rows.mapInArrow(count, _SEALED_WITH)
    stream = way.cipher(F.col("blocks"), F.col(_KEY))
    combined_rows = counted.select("rows", "nonces", stream.alias("stream"), _KEY, F.unix_timestamp().alias("clock")).mapInArrow(combine, schema)
    return combined_rows.select(*names[:n], *[F.col(name).alias(c) for name, c in zip(names[n:], others)])


def _raw(batch: pa.RecordBatch, n: int, given: bool) -> pa.RecordBatch:
    """The bytes of ``n`` columns of tokens, which come after the key."""
    return pa.RecordBatch.from_arrays([batch.column(0), *[_decoded(c, given) for c in batch.columns[1:n + 1]], *batch.columns[n + 1:]], names=batch.schema.names)


def _cut(batch: pa.RecordBatch, n: int) -> Iterator[tuple[bytes, pa.RecordBatch]]:
    """Some rows of one key at a time, and their key; its column is left out, the first ``n`` others are cells."""
    keys = batch.column(0).dictionary_encode()
    for k, key in enumerate(keys.dictionary.to_pylist()):
        some = (batch if len(keys.dictionary) == 1 else batch.filter(pc.equal(keys.indices, k))).select(batch.schema.names[1:])
        size = np.zeros(some.num_rows, np.int64)
        for c in some.columns[:n]:
            size += pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False)
        upto, at = np.concatenate([[0], np.cumsum(size)]), 0
        while at < some.num_rows:
            end = min(at + max(1, CELLS // max(1, n)), max(at + 1, int(np.searchsorted(upto, upto[at] + TEXT, "right")) - 1))
            yield key, some.slice(at, end - at)
            at = end


def _stored(batch: pa.RecordBatch) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as file:
        file.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Flat:
    """The cells of some columns one after the other: bytes, and where each cell begins and how long it is; a null is empty."""

    def __init__(self, columns: list[pa.Array]):
        cells = pa.concat_arrays([c.cast(pa.large_binary()) for c in columns])
        self.valid = cells.is_valid()
        _, offsets, data = cells.fill_null(b"").buffers()
        at = np.frombuffer(offsets, np.int64)[:len(cells) + 1] if len(cells) else np.zeros(1, np.int64)
        self.at, self.size = at[:-1], np.diff(at)
        self.bytes = np.frombuffer(data, np.uint8)[:at[-1]] if data is not None else np.zeros(0, np.uint8)

    def token(self) -> tuple[np.ndarray, _Part]:
        """Which cells are long enough for a token, and the ciphertexts of all."""
        long = self.size >= GCM_OVERHEAD
        return long, _Part(self.at + NONCE, np.where(long, self.size - GCM_OVERHEAD, 0))


class _Part:
    """A piece of each cell: the places of its bytes, and those of the same bytes in whole blocks, each piece in blocks of its own."""

    def __init__(self, at: np.ndarray, size: np.ndarray):
        self.size, self.blocks = size, -(-size // AES_BLOCK)
        run = np.arange(size.sum()) - np.repeat(_before(size), size)
        self.places = run + np.repeat(at, size)
        self.padded = run + np.repeat(AES_BLOCK * _before(self.blocks), size)

    def in_blocks(self, found: np.ndarray) -> np.ndarray:
        out = np.zeros(AES_BLOCK * int(self.blocks.sum()), np.uint8)
        out[self.padded] = found
        return out.reshape(-1, AES_BLOCK)


def _before(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _nonces(flat: _Flat) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(os.urandom(NONCE * len(flat.size)), np.uint8).reshape(-1, NONCE), flat.size


def _given(flat: _Flat) -> tuple[np.ndarray, np.ndarray]:
    """Of what is too short for a token, the nonce is of zeros."""
    long, text = flat.token()
    own = np.zeros((len(long), NONCE), np.uint8)
    own[long] = flat.bytes[flat.at[long][:, None] + np.arange(NONCE)]
    return own, text.size


def _counters(nonces: np.ndarray, each: np.ndarray) -> bytes:
    """A block of zeros, for the hash, and ``each`` counters from 1 after every nonce."""
    blocks = np.zeros((1 + int(each.sum()), 4), np.uint32)
    blocks[1:, :3] = np.repeat(np.ascontiguousarray(nonces).view(np.uint32).reshape(-1, 3), each, axis=0)
    blocks[1:, 3] = (np.arange(each.sum()) - np.repeat(_before(each), each) + 1).astype(">u4").view(np.uint32)
    return blocks.tobytes()


def _streams(stream: np.ndarray, blocks: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Of what the counters became: the hash's element, the block of each tag, and the blocks for the texts."""
    first = 1 + _before(blocks + 1)
    texts = np.ones(1 + int((blocks + 1).sum()), bool)
    texts[0] = texts[first] = False
    return stream[0].tobytes(), stream[first], stream[:len(texts)][texts]


def _sealed(flat: _Flat, nonces: np.ndarray, stream: np.ndarray) -> pa.Array:
    text = _Part(flat.at, flat.size)
    element, masks, keys = _streams(stream, text.blocks)
    sealed = flat.bytes ^ keys.reshape(-1)[text.padded]
    tags = _hashed(text.in_blocks(sealed), text, element) ^ masks
    token = flat.size + GCM_OVERHEAD
    at = _before(token)
    out = np.empty(int(token.sum()), np.uint8)
    out[at[:, None] + np.arange(NONCE)] = nonces
    out[_Part(at + NONCE, flat.size).places] = sealed
    out[(at + NONCE + flat.size)[:, None] + np.arange(TAG)] = tags
    return _array(flat.valid, token, out)


def _tags_match(flat: _Flat, long: np.ndarray, text: _Part, element: bytes, masks: np.ndarray) -> np.ndarray:
    tags = _hashed(text.in_blocks(flat.bytes[text.places]), text, element) ^ masks
    same = np.zeros(len(long), bool)
    end = (flat.at + flat.size - TAG)[long]
    same[long] = (flat.bytes[end[:, None] + np.arange(TAG)] == tags[long]).all(axis=1)
    return same


def _opened(flat: _Flat, nonces: np.ndarray, stream: np.ndarray) -> pa.Array:
    long, text = flat.token()
    element, masks, keys = _streams(stream, text.blocks)
    if not (_tags_match(flat, long, text, element, masks) | ~flat.valid.to_numpy(zero_copy_only=False)).all():
        raise ValueError("invalid token: its tag does not match, so it is changed or of another key")
    return _array(flat.valid, text.size, flat.bytes[text.places] ^ keys.reshape(-1)[text.padded])


def _intact(flat: _Flat, nonces: np.ndarray, stream: np.ndarray) -> pa.Array:
    long, text = flat.token()
    element, masks, _ = _streams(stream, text.blocks)
    return pa.array(_tags_match(flat, long, text, element, masks), mask=~flat.valid.to_numpy(zero_copy_only=False))


def _array(valid: pa.Array, size: np.ndarray, found: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    cells = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(found))])
    return pc.if_else(valid, cells, pa.scalar(None, pa.binary()))


def _encoded(cells: pa.Array) -> pa.Array:
    """Padded URL-safe Base64 of each: with zeros up to whole threes, all are encoded at once."""
    flat = _Flat([cells])
    size = -(-flat.size // 3) * 3
    whole = np.zeros(int(size.sum()), np.uint8)
    if len(size) and (flat.size == flat.size[0]).all():
        whole.reshape(len(size), -1)[:, :flat.size[0]] = flat.bytes.reshape(len(size), -1)
    else:
        whole[_Part(_before(size), flat.size).places] = flat.bytes
    text = np.frombuffer(binascii.b2a_base64(whole, newline=False).translate(URL_SAFE), np.uint8).copy()
    end = np.cumsum(size // 3 * 4)
    text[end[size > flat.size] - 1] = PAD
    text[end[size > flat.size + 1] - 2] = PAD
    return _array(flat.valid, size // 3 * 4, text).cast(pa.string())


def _decoded(tokens: pa.Array, given: bool) -> pa.Array:
    """The bytes of each token, as ``token_bytes`` has them, or, where the tokens are only ``given`` to be checked, as ``try_token_bytes`` has them.

    Tokens as ``_encoded`` writes them are decoded at once, any others one by one.
    """
    usual = pc.and_(pc.match_substring_regex(tokens, USUAL), pc.equal(pc.bit_wise_and(pc.binary_length(tokens), 3), 0)).fill_null(True)
    all_usual = pc.all(usual, min_count=0).as_py()
    flat = _Flat([tokens if all_usual else pc.if_else(usual, tokens, pa.scalar("", tokens.type))])
    end, there = flat.at + flat.size, flat.size > 0
    pads = np.zeros(len(end), np.int64)
    for back in (1, 2):
        pads[there] += flat.bytes[end[there] - back] == PAD
    whole = np.frombuffer(binascii.a2b_base64(flat.bytes.tobytes().translate(FROM_URL_SAFE)), np.uint8)
    room = flat.size // 4 * 3
    size = room - pads
    if len(size) and (room == room[0]).all() and (pads == pads[0]).all():
        found = whole.reshape(len(size), -1)[:, :size[0]] if len(whole) else whole
    else:
        found = whole[_Part(_before(room), size).places]
    raws = _array(flat.valid, size, np.ascontiguousarray(found).reshape(-1))
    if all_usual:
        return raws
    return pc.replace_with_mask(raws, pc.invert(usual), pa.array([_odd_decoded(t, given) for t in tokens.filter(pc.invert(usual)).cast(pa.binary()).to_pylist()], pa.binary()))


def _odd_decoded(text: bytes, given: bool) -> bytes:
    """As Spark decodes: the usual alphabet may stand for the URL-safe one, white space before the padding is left out and padding may be missing."""
    token = text.decode(errors="replace")
    body = token.rstrip("=")
    pads, bare = len(token) - len(body), "".join(c for c in body.replace("-", "+").replace("_", "/") if not _is_space(c))
    if all(c in STANDARD for c in bare) and len(bare) % 4 != 1 and pads in (0, -len(bare) % 4) and not (given and len(token) % 4):
        return binascii.a2b_base64(bare + "=" * (-len(bare) % 4))
    if given:
        return b""
    raise ValueError("invalid token: no Base64")


def _is_space(character: str) -> bool:
    """White space as Java has it."""
    return character in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f" or unicodedata.category(character) in ("Zs", "Zl", "Zp") and character not in "\xa0\u2007\u202f"


def _hashed(blocks: np.ndarray, text: _Part, element: bytes) -> np.ndarray:
    """GHASH of each piece's blocks and of its length: neighbours are joined to one block, then those, so the rounds are few for long texts too."""
    n = text.blocks + 1
    last = np.cumsum(n) - 1
    left = np.zeros((int(n.sum()), 2), np.uint64)
    of_text = np.ones(len(left), bool)
    of_text[last] = False
    left[of_text] = blocks.view(np.uint64)
    left[last, 1] = (8 * text.size).astype(">u8").view(np.uint64)
    powers = _powers(element)
    power = next(powers)
    while len(left) > len(n):
        # Counted from the end of each piece, an odd block is the left one of a pair.
        right = (np.repeat(np.cumsum(n), n) - np.arange(len(left))) % 2 == 1
        joined, odd = left[right], np.flatnonzero(~right)
        joined[np.cumsum(right)[odd]] ^= _times(left[odd], power)
        left, n, power = joined, (n + 1) // 2, next(powers)
    return _times(left, _table(element)).view(np.uint8).reshape(-1, TAG)


def _powers(element: bytes) -> Iterator[np.ndarray]:
    """The tables of the element, its square, the square of that, and so on."""
    while True:
        table = _table(element)
        yield table
        element = _times(np.frombuffer(element, np.uint64).reshape(1, 2), table).tobytes()


def _times(blocks: np.ndarray, table: np.ndarray) -> np.ndarray:
    found = np.zeros((len(blocks), 2), np.uint64)
    for at, column in enumerate(np.ascontiguousarray(blocks).view(np.uint8).reshape(-1, AES_BLOCK).T):
        column = np.ascontiguousarray(column)
        if column.any():
            found ^= table[at][column]
    return found


@lru_cache(maxsize=64)
def _table(element: bytes) -> np.ndarray:
    """Products of an element of the field with every value of every byte."""
    table = np.zeros((AES_BLOCK, 256, 2), np.uint64)
    x = int.from_bytes(element)
    for at in range(AES_BLOCK):
        for bit in (128 >> i for i in range(8)):
            table[at, bit] = np.frombuffer(x.to_bytes(AES_BLOCK), np.uint64)
            x = x >> 1 ^ (POLYNOMIAL if x & 1 else 0)
        for bit in (1 << i for i in range(8)):
            table[at, bit:2 * bit] = table[at, :bit] ^ table[at, bit]
    return table


def _padded(flat: _Flat, key: bytes, method: str) -> bytes:
    """A block of zeros, whose ciphertext is the IV, before every padded text."""
    size = AES_BLOCK * (flat.size // AES_BLOCK + 2)
    at = _before(size)
    out = np.repeat((AES_BLOCK - flat.size % AES_BLOCK).astype(np.uint8), size)
    out.reshape(-1, AES_BLOCK)[at // AES_BLOCK] = 0
    out[_Part(at + AES_BLOCK, flat.size).places] = flat.bytes
    return out.tobytes()


def _chain_sealed(flat: _Flat, stream: bytes, key: bytes, clock: int, method: str) -> pa.Array:
    size = AES_BLOCK * (flat.size // AES_BLOCK + 2)
    if method == "cbc":
        return _array(flat.valid, size, np.frombuffer(stream, np.uint8)[IV_BYTES:IV_BYTES + int(size.sum())])
    first = bytes([FERNET_VERSION]) + int(clock).to_bytes(8)
    inner, outer = _mac_states(key)
    inner.update(first)
    found, view, at = [], memoryview(stream), IV_BYTES
    for n in size.tolist():
        sealed = view[at:at + n]
        at += n
        body = inner.copy()
        body.update(sealed)
        mac = outer.copy()
        mac.update(body.digest())
        found += (first, sealed, mac.digest())
    return _array(flat.valid, size + (FERNET_OVERHEAD - IV_BYTES), np.frombuffer(b"".join(found), np.uint8))


def _mac_states(key: bytes) -> tuple:
    """HMAC-SHA256 up to the message, and up to the digest of that."""
    parts = key_parts(key)
    return hashlib.sha256(parts["inner"]), hashlib.sha256(parts["outer"])


def _macs_match(flat: _Flat, key: bytes) -> np.ndarray:
    """Which cells are long enough for a ``fernet`` token, have its version and a MAC that fits."""
    inner, outer = _mac_states(key)
    same, view = np.zeros(len(flat.size), bool), memoryview(flat.bytes)
    for i in np.flatnonzero(flat.size >= FERNET_OVERHEAD + AES_BLOCK).tolist():
        at = int(flat.at[i])
        end = at + int(flat.size[i]) - MAC_BYTES
        body = inner.copy()
        body.update(view[at:end])
        mac = outer.copy()
        mac.update(body.digest())
        same[i] = view[at] == FERNET_VERSION and view[end:end + MAC_BYTES] == mac.digest()
    return same


def _chain_parts(flat: _Flat, method: str) -> tuple[np.ndarray, np.ndarray]:
    """Where IV and ciphertext of each token begin, and their length; of a null, nothing."""
    other = FERNET_OVERHEAD - IV_BYTES if method == "fernet" else 0
    return flat.at + (9 if method == "fernet" else 0), np.where(flat.valid.to_numpy(zero_copy_only=False), flat.size - other, 0)


def _whole(flat: _Flat, key: bytes, method: str) -> bytes | None:
    """IVs and ciphertexts one after the other, which are one message; none without any."""
    valid = flat.valid.to_numpy(zero_copy_only=False)
    at, size = _chain_parts(flat, method)
    whole = (size % AES_BLOCK == 0) & (size >= IV_BYTES + AES_BLOCK)
    if method == "fernet":
        whole &= _macs_match(flat, key)
    if not (whole | ~valid).all():
        raise ValueError("invalid token: " + ("version or HMAC does not match" if method == "fernet" else "no whole blocks"))
    return flat.bytes[_Part(at, size).places].tobytes() or None


def _chain_opened(flat: _Flat, stream: bytes | None, key: bytes, clock: int, method: str) -> pa.Array:
    _, size = _chain_parts(flat, method)
    n = np.zeros(len(size), np.int64)
    there = np.flatnonzero(size)
    if stream is None or not len(there):
        return _array(flat.valid, n, np.zeros(0, np.uint8))
    # The cipher itself has taken the pad of the last token.
    taken = int(size.sum()) - IV_BYTES - len(stream)
    message = np.frombuffer(stream + bytes([taken]) * taken, np.uint8)
    at = _before(size)
    end = (at + size - IV_BYTES)[there]
    last = message[(end - AES_BLOCK)[:, None] + np.arange(AES_BLOCK)]
    pad = last[:, -1].astype(np.int64)
    padded = ((last == last[:, -1:]) | (np.arange(AES_BLOCK) < (AES_BLOCK - pad)[:, None])).all(axis=1)
    if not (padded & (pad >= 1) & (pad <= AES_BLOCK)).all():
        raise ValueError("invalid token: its padding is wrong, so it is changed or of another key")
    n[there] = size[there] - IV_BYTES - pad
    return _array(flat.valid, n, message[_Part(at, n).places])
