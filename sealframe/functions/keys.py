"""Key material as a one-row subquery, so that no key byte is ever a literal of a plan."""

from __future__ import annotations

import base64
import binascii
from typing import TYPE_CHECKING, Union

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sealframe.functions.text import cell

if TYPE_CHECKING:
    from sealframe.functions.keyring import KeyRing

# The key size, and the block size and pad bytes of HMAC-SHA256 (RFC 2104).
KEY_BYTES = 32
HMAC_BLOCK = 64
INNER_PAD = 0x36
OUTER_PAD = 0x5C

KEY = "__sealframe_key"


def decode_key(text: str | bytes) -> bytes:
    """Key bytes from their URL-safe Base64 form; anything but 32 bytes is refused."""
    raw = text.encode("ascii") if isinstance(text, str) else text
    try:
        return check_key(base64.urlsafe_b64decode(raw.strip()))
    except binascii.Error as bad:
        raise ValueError("the key is not valid URL-safe Base64") from bad


def check_key(key: bytes) -> bytes:
    if not isinstance(key, bytes | bytearray) or len(key) != KEY_BYTES:
        raise ValueError(f"the key must be exactly {KEY_BYTES} bytes")
    return bytes(key)


# One key, a key for each value (as text) of a slice column, or a ring of stored keys.
Keys = Union[bytes, dict[str, bytes], "KeyRing"]


def is_ring(key: Keys) -> bool:
    return hasattr(key, "keyed")


def with_key(df: DataFrame, key: Keys, slice_column: str | None = None, name: str = KEY) -> DataFrame:
    """``df`` with the column ``KEY`` (or another ``name``): a struct of the key and the parts derived from it.

    A literal key would be printed in plans, the UI and event logs, and would let the
    optimizer fold a constant cell into one shared token. A scalar subquery over a local
    relation prints only its column names, is not foldable and needs no join. With
    ``slice_column`` it is a map; a value without a key fails the query, a null one too. A ring joins its
    table of keys instead.
    """
    if is_ring(key):
        return key.keyed(df, slice_column, name)
    keys = {"": key} if slice_column is None else key
    if not isinstance(keys, dict) or not keys:
        raise ValueError("a slice column needs a key for each of its values")
    parts = {name: key_parts(value) for name, value in keys.items()}
    fields = list(next(iter(parts.values())))
    table = pa.table({"slice": pa.array(list(parts), pa.string())} | {f: pa.array([p[f] for p in parts.values()], pa.binary()) for f in fields})
    material = df.sparkSession.createDataFrame(table)
    if slice_column is None:
        return df.select("*", material.select(F.struct(*fields)).scalar().alias(name))
    pairs = material.agg(F.map_from_entries(F.collect_list(F.struct("slice", F.struct(*fields).alias("parts"))))).scalar()
    found = F.try_element_at(pairs, cell(slice_column).cast("string"))
    missing = F.raise_error(F.lit(f"no key for a value of {slice_column}"))
    return df.select("*", F.coalesce(found, missing.cast(f"struct<{','.join(f'{f}:binary' for f in fields)}>")).alias(name))


def key_parts(key: bytes) -> dict[str, bytes]:
    """A key and what the methods derive from it."""
    key = check_key(key)
    signing, sealing = key[:16], key[16:]
    padded = signing.ljust(HMAC_BLOCK, b"\0")
    return {
        "whole": key,
        "sealing": sealing,
        "inner": bytes(b ^ INNER_PAD for b in padded),
        "outer": bytes(b ^ OUTER_PAD for b in padded),
    }
