"""Seal and open every cell of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sealframe.functions.batches import open_batches, seal_batches
from sealframe.functions.keyring import KEY_ID
from sealframe.functions.keys import KEY, Keys, is_ring, with_key
from sealframe.functions.text import called, cell, cell_text
from sealframe.functions.tokens import chain_text, chain_token, check_batches_method, check_long_chains_method, open_bytes, open_chain, opened_text, seal, seal_chain, token_bytes
from sealframe.session import dealt

# Cells of a row that one call of the cipher takes: where each lies is said by the lengths of those before it.
CHAIN = 8


def _in_chains(df: DataFrame, cells: list[str], made) -> tuple[DataFrame, list[tuple[str, list[Column], int]]]:
    """``df`` with a column for every ``CHAIN`` cells, and of each cell that column, the cells in it and its place there.

    A generator makes the column, since no rule of the optimizer takes that apart or makes it twice.
    """
    found = []
    for n, first in enumerate(range(0, len(cells), CHAIN)):
        some, chain = [F.col(c) for c in cells[first:first + CHAIN]], f"__chain{n}"
        df = df.select("*", F.inline(called(F.lit(n), lambda _: F.array(F.struct(made(some).alias(chain))))))
        found += [(chain, some, i) for i in range(len(some))]
    return df, found


def seal_cells(keyed: DataFrame, texts: dict[str, Column], method: str, others: tuple[str, ...] | list[str] = (), *,
               batches: bool = False, long_chains: bool = False) -> DataFrame:
    """A token of each of ``texts``, and the columns ``others`` as they are; ``keyed`` has the key of ``with_key``."""
    check_batches_method(method, batches)
    check_long_chains_method(method, long_chains)
    if (batches or long_chains) and texts:
        names = [f"__cell{i}" for i in range(len(texts))]
        made = seal_batches(keyed, dict(zip(names, texts.values())), list(others), method)
        return made.select(*[F.col(n).alias(c) for n, c in zip(names, texts)], *map(cell, others))
    if method == "gcm":
        return keyed.select(*[seal(t, F.col(KEY), method).alias(c) for c, t in texts.items()], *map(cell, others))
    names = [f"__cell{i}" for i in range(len(texts))]
    rows = keyed.select(KEY, *[t.alias(n) for n, t in zip(names, texts.values())], *map(cell, others))
    rows, places = _in_chains(rows, names, lambda some: seal_chain(some, F.col(KEY), method))
    return rows.select(*[chain_token(F.col(chain), some, i, F.col(KEY), method).alias(c) for c, (chain, some, i) in zip(texts, places)], *map(cell, others))


def open_cells(keyed: DataFrame, tokens: list[str], method: str, others: tuple[str, ...] | list[str] = (), *,
               batches: bool = False, long_chains: bool = False) -> DataFrame:
    """The text of each of the columns ``tokens``, and the columns ``others`` as they are."""
    check_batches_method(method, batches)
    check_long_chains_method(method, long_chains)
    names = [f"__cell{i}" for i in range(len(tokens))]
    if (batches or long_chains) and tokens:
        opened = open_batches(keyed, {n: cell(c) for n, c in zip(names, tokens)}, list(others), method)
        return opened.select(*[opened_text(F.col(n)).alias(c) for n, c in zip(names, tokens)], *map(cell, others))
    # Decoded in a projection of its own: a method may look at the bytes more than once.
    raw = keyed.select(KEY, *[token_bytes(cell(c)).alias(n) for n, c in zip(names, tokens)], *map(cell, others))
    if method == "gcm":
        return raw.select(*[open_bytes(F.col(n), F.col(KEY), method).alias(c) for n, c in zip(names, tokens)], *map(cell, others))
    raw, places = _in_chains(raw, names, lambda some: open_chain(some, F.col(KEY), method))
    return raw.select(*[chain_text(F.col(chain), some, i, method).alias(c) for c, (chain, some, i) in zip(tokens, places)], *map(cell, others))


def encrypt_table(df: DataFrame, key: Keys, method: str = "gcm", *, hide_nulls: bool = False,
                  partitions: int | None = None, slice_column: str | None = None, batches: bool = False,
                  long_chains: bool = False) -> DataFrame:
    """Every cell of every column as a token; column names stay clear.

    The result is random: each action seals anew. Store it before comparing or joining it,
    and shuffle before sealing, never after, because a task that is run again would place
    its new tokens elsewhere; ``partitions`` asks for such a shuffle. Columns that are the same
    expression of the same input share one token within a row; stored columns never do.

    With ``slice_column``, ``key`` has a key for the text of each of its values, and the column itself
    stays clear, so that the rows can be opened again. A ring counts the cells of each slice when this is called, and has the keys
    it needs for one evaluation of the result; the slice column is sealed too, and the column ``key_id`` names each row's key.

    ``batches`` (``gcm`` only) has the cells of many rows sealed by one call of the cipher instead of one each; the tokens are the same, but
    texts and keys reach the Python workers. ``long_chains`` (``cbc`` and ``fernet``) has those of many rows in one chain, likewise.
    """
    check_batches_method(method, batches)
    check_long_chains_method(method, long_chains)
    ring = is_ring(key)
    if ring:
        if KEY_ID in df.columns:
            raise ValueError(f"the column name {KEY_ID} is taken")
        key.reserve(df, slice_column, len(df.columns))
        keyed = key.keyed(df, slice_column, partitions=partitions)
    else:
        keyed = with_key(dealt(df, partitions), key, slice_column)
    clear = [c for c in df.columns if c == slice_column and not ring] + ([KEY_ID] if ring else [])
    texts = {f.name: cell_text(f.name, f.dataType, hide_nulls) for f in df.schema if f.name not in clear}
    return seal_cells(keyed, texts, method, clear, batches=batches, long_chains=long_chains).select(*map(cell, df.columns), *([KEY_ID] if ring else []))


def decrypt_table(df: DataFrame, key: Keys, method: str = "gcm",
                  numeric_columns: list[str] | tuple[str, ...] | dict[str, str] = (), *, slice_column: str | None = None,
                  batches: bool = False, long_chains: bool = False) -> DataFrame:
    """Every token as its text, listed columns as numbers; listed names that are not there are skipped.

    A list means doubles; a dictionary names a type for each column (``{"id": "bigint"}``), so that
    long integers keep their digits. A changed token (for ``cbc`` only where the text is no longer
    valid) or text that is no number of the type fails the query. ``batches`` and ``long_chains`` as in ``encrypt_table``.
    """
    check_batches_method(method, batches)
    check_long_chains_method(method, long_chains)
    types = numeric_columns if isinstance(numeric_columns, dict) else dict.fromkeys(numeric_columns, "double")
    # A ring needs no slices to open: every row names its key.
    sealed = [c for c in df.columns if c != (KEY_ID if is_ring(key) else slice_column)]
    clear = [] if is_ring(key) else [c for c in df.columns if c not in sealed]
    opened = open_cells(with_key(df, key, slice_column), sealed, method, clear, batches=batches, long_chains=long_chains)
    return opened.select(*[(as_number(cell(c), c, types[c]) if c in types and c in sealed else cell(c)).alias(c) for c in df.columns if c in sealed or c in clear])


# The texts of numbers. Spark's cast would also take 5d, 1f and 0x1p3, so letters are looked at first; what has none
# but e is left to the cast.
INTEGER = r"^[+-]?[0-9]+$"
PLAIN = r"^[0-9eE+.-]+$"
SPECIAL = r"^([+-]?inf|nan)$"


def as_number(text: Column, name: str, type_: str) -> Column:
    """The text as a number of the type; text that is none fails the query."""
    return called(text, lambda t: _as_number(t, name, type_))


def _as_number(text: Column, name: str, type_: str) -> Column:
    shape = F.rlike(text, F.lit(PLAIN if type_ in ("double", "float") or type_.startswith("decimal") else INTEGER))
    if type_ in ("double", "float"):
        shape = shape | F.rlike(text, F.lit(SPECIAL))
    bad = F.when(text.isNotNull(), F.raise_error(F.lit(f"not a number of type {type_} in column {name}")))
    return F.coalesce(F.when(shape, text.try_cast(type_)), bad.cast(type_))
