"""Tokens that are valid in one place only, and a check that finds swapped, dropped and repeated cells.

A GCM token proves that its cell is unchanged, not where it belongs. Here every token is sealed with its column and a tag of
its row as associated data, so it opens nowhere else. The tag is a keyed digest of the row's key; it says which row this is to
those who have the key only. What no single token can show, that cells are missing or there twice, shows in a digest of a
whole column that does not depend on the order of rows: the sum of keyed digests of its cells, taken when the table is
stored and again when it is checked.
"""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column, DataFrame, functions as F

from sealframe.functions.keys import KEY, Keys, is_ring, with_key
from sealframe.functions.text import cell, cell_text
from sealframe.functions.tokens import keyed_digest, keyed_digest_hex, open_bytes, seal, token_bytes, try_open, try_token_bytes
from sealframe.operators.cipher import as_number
from sealframe.session import dealt

TAG = "row_tag"
TAG_KEY = "__sealframe_tag_key"
# The labels that part the keys of tags and digests from those of cells, and one use from the other.
LABEL = b"sealframe row tags"
ROW, CELL = "row", "cell"


def _tag_keys(key: Keys) -> Keys:
    if is_ring(key):
        raise TypeError("places are bound with one key, or one for each slice")
    derive = lambda k: hmac.new(k, LABEL, hashlib.sha256).digest()
    return {name: derive(k) for name, k in key.items()} if isinstance(key, dict) else derive(key)


def _keyed(df: DataFrame, key: Keys, slice_column: str | None) -> DataFrame:
    return with_key(with_key(df, key, slice_column), _tag_keys(key), slice_column, TAG_KEY)


def _message(*parts: Column | str) -> Column:
    """Texts one after the other with their lengths, so that no two lists give the same; null is a part of its own."""
    texts = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-:")) for t in texts])


def _row_tag(table: str, parts: list[Column]) -> Column:
    mac = F.base64(keyed_digest(_message(ROW, table, *parts).cast("binary"), F.col(TAG_KEY)))
    return F.translate(mac, "+/\r\n", "-_")


def _place(column: str) -> Column:
    return _message(column, F.col(TAG))


def seal_in_place(df: DataFrame, key: Keys, row_key: list[str] | tuple[str, ...], table: str, *, hide_nulls: bool = False,
                  partitions: int | None = None, slice_column: str | None = None, clear: tuple[str, ...] = ()) -> DataFrame:
    """Every cell as a GCM token bound to its column, its row and the name ``table``, and the column ``row_tag``.

    ``row_key`` names the columns that tell rows apart; rows with equal keys have one tag, and their cells may change places. The
    result is random: store it before use. ``slice_column`` stays clear, as in ``encrypt_table``; rows of different slices
    never share a tag. The columns of ``clear`` stay as they are too, and nothing protects them.
    """
    if TAG in df.columns:
        raise ValueError(f"the column name {TAG} is taken")
    types = {f.name: f.dataType for f in df.schema}
    keyed = _keyed(dealt(df, partitions), key, slice_column)
    tagged = keyed.withColumn(TAG, _row_tag(table, [cell_text(c, types[c]) for c in row_key]))
    return tagged.select(*[
        cell(c) if c == slice_column or c in clear else seal(cell_text(c, t, hide_nulls), F.col(KEY), "gcm", place=_place(c)).alias(c) for c, t in types.items()
    ], TAG)


def open_in_place(df: DataFrame, key: Keys, row_key: list[str] | tuple[str, ...], table: str, numeric_columns: list[str] | tuple[str, ...] | dict[str, str] = (), *,
                  slice_column: str | None = None, clear: tuple[str, ...] = ()) -> DataFrame:
    """The cells of ``seal_in_place`` without the tag. One that is changed or in another place fails the query, and so does a tag
    that is not that of the row's key."""
    types = numeric_columns if isinstance(numeric_columns, dict) else dict.fromkeys(numeric_columns, "double")
    sealed = [c for c in df.columns if c not in (slice_column, TAG, *clear)]
    keyed = _keyed(df, key, slice_column)
    opened = keyed.select(KEY, TAG_KEY, TAG, *[(open_bytes(token_bytes(cell(c)), F.col(KEY), "gcm", place=_place(c)) if c in sealed else cell(c)).alias(c)
                                               for c in df.columns if c != TAG])
    right = F.col(TAG) == _row_tag(table, [cell(c) if c in sealed else cell_text(c, df.schema[c].dataType) for c in row_key])
    checked = opened.withColumn(TAG, F.when(right, F.col(TAG)).otherwise(F.raise_error(F.lit("a row's tag is not that of its key"))))
    # A filter on the tag, or it would be left out with its check.
    return checked.where(F.col(TAG).isNotNull()).select(*[
        (as_number(cell(c), c, types[c]) if c in types and c in sealed else cell(c)).alias(c) for c in df.columns if c != TAG])


def _digest_sum(digits: Column) -> Column:
    """Sums of four numbers of 64 bits each; equal cells add up, where a bitwise sum would cancel them.

    Each is taken in two halves, as decimals that Spark holds in a long while they are short.
    """
    half = [F.sum(F.conv(F.substring(digits, at, 8).cast("string"), 16, 10).cast("bigint").cast("decimal(12,0)")) for at in range(1, 65, 8)]
    sums = [high * F.lit(2**32).cast("decimal(10,0)") + low for high, low in zip(half[::2], half[1::2])]
    return F.concat_ws("-", *[F.coalesce(s, F.lit(0)).cast("string") for s in sums])


def column_manifest(df: DataFrame, key: Keys, *, slice_column: str | None = None, clear: tuple[str, ...] = ()) -> DataFrame:
    """Per column of a stored table of ``seal_in_place``: rows, cells that are not null, and the digest of all cells.

    One pass without a shuffle of rows; nothing is opened. Keep it where those who can write the table cannot write. Manifests of parts of a table
    have to be taken again for the whole.
    """
    sealed = [c for c in df.columns if c not in (slice_column, TAG, *clear)]
    # Digests in a projection of their own, as digits in bytes: parts of a text are found from its start, one character after the other.
    digests = _keyed(df, key, slice_column).select(*[cell(c).isNotNull().alias(f"there{i}") for i, c in enumerate(sealed)], *[
        keyed_digest_hex(_message(CELL, c, F.col(TAG), cell(c)).cast("binary"), F.col(TAG_KEY)).cast("binary").alias(f"digest{i}") for i, c in enumerate(sealed)])
    made = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(f"there{i}")).alias("cells"), _digest_sum(F.col(f"digest{i}")).alias("digest")).alias(f"c{i}")
            for i, c in enumerate(sealed)]
    totals = digests.agg(*made)
    return totals.select(F.inline(F.array(*totals.columns)))


def place_report(df: DataFrame, manifest: DataFrame, key: Keys, *, slice_column: str | None = None, clear: tuple[str, ...] = ()) -> DataFrame:
    """What has become of each column since its manifest: ``intact`` whether the digest is the same, ``cells`` now, ``bad_cells``
    that do not open in their place, ``repeated`` good cells of rows that have one already, and ``missing`` cells of the manifest without a good one.

    Rows are gathered by their tags, map-side first; two numbers for each column travel, so a row that is there a million times
    is no burden. Where the digest of every column is the same, all of that is known to be in order and is not done.
    """
    sealed = [c for c in df.columns if c not in (slice_column, TAG, *clear)]
    now = column_manifest(df, key, slice_column=slice_column, clear=clear).select("column", F.col("rows").alias("rows_now"), F.col("cells").alias("cells_now"), F.col("digest").alias("digest_now"))
    # A row for each column.
    compared = manifest.join(now, "column", "full").select(
        "column", "cells", "cells_now", F.coalesce((F.col("digest") == F.col("digest_now")) & (F.col("rows") == F.col("rows_now")), F.lit(False)).alias("intact")).collect()
    schema = "column string, intact boolean, cells bigint, bad_cells bigint, repeated bigint, missing bigint"
    if all(r.intact for r in compared):
        return df.sparkSession.createDataFrame([(r["column"], True, r.cells, 0, 0, 0) for r in compared], schema)
    known = {r["column"]: r for r in compared}
    raw = _keyed(df, key, slice_column).select(KEY, TAG, *[try_token_bytes(cell(c)).alias(c) for c in sealed])
    good = [try_open(cell(c), F.col(KEY), place=_place(c)) for c in sealed]
    rows = raw.select(TAG, *[F.when(cell(c).isNotNull(), g.isNotNull()).alias(f"g{i}") for i, (c, g) in enumerate(zip(sealed, good))])
    by_row = rows.groupBy(TAG).agg(*[f(F.col(f"g{i}")).alias(f"{n}{i}") for i in range(len(sealed)) for n, f in (("good", F.count_if), ("all", F.count))])
    totals = by_row.agg(*[F.struct(*[F.coalesce(v, F.lit(0)).alias(n) for n, v in {
        "all": F.sum(f"all{i}"), "good": F.sum(f"good{i}"), "rows": F.count_if(F.col(f"good{i}") > 0)}.items()]).alias(f"c{i}") for i in range(len(sealed))])
    # Columns of the manifest that are gone have lost all their cells; columns that are new belong to nowhere.
    out = []
    for c in known:
        if c in sealed:
            t, had = F.col(f"c{sealed.index(c)}"), known[c].cells or 0
            out.append((c, t["all"], t["all"] - t["good"], t["good"] - t["rows"], F.lit(had) - t["rows"]))
        else:
            out.append((c, F.lit(0), F.lit(0), F.lit(0), F.lit(known[c].cells)))
    fields = ("cells", "bad_cells", "repeated", "missing")
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(known[c].intact).alias("intact"), *[v.cast("bigint").alias(n) for n, v in zip(fields, values)]) for c, *values in out])))
