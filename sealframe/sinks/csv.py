"""CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sealframe.functions.keys import Keys
from sealframe.functions.text import cell
from sealframe.operators.cipher import encrypt_table

# Fixed value: how a missing cell is written. A text that starts with a backslash gets another one,
# so no text looks like it.
MISSING = "\\N"


def sink_csv(df: DataFrame, folder: str, source_name: str, missing: str = MISSING) -> str:
    """Write ``transform_<source name>`` in ``folder``, replacing it, and return its path.

    The path is a directory of part files, each with a header line. Quotes are doubled, blanks
    kept, empty texts quoted and missing cells written as ``missing`` (a backslash and more), so that
    every cell survives and no row is a blank line.
    """
    if not missing.startswith("\\") or missing.startswith("\\\\") or len(missing) < 2:
        raise ValueError("a missing cell is written as one backslash and other characters")
    path = f"{folder.rstrip('/')}/transform_{source_name}"
    (
        df.select(*[_marked(f).alias(f.name) for f in df.schema])
        .write.mode("overwrite")
        .options(header=True, escape='"', nullValue=missing, emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
    return path


def _marked(field: T.StructField):
    text = cell(field.name)
    return F.when(F.startswith(text, F.lit("\\")), F.concat(F.lit("\\"), text)).otherwise(text) if isinstance(field.dataType, T.StringType) else text


def sink_csv_encrypted(df: DataFrame, folder: str, source_name: str, key: Keys,
                       method: str = "gcm", *, partitions: int | None = None, slice_column: str | None = None, batches: bool = False) -> str:
    """The same with every cell a token; the header stays readable, and so do the cells of a ``slice_column``, which have
    a key for each value in ``key``. ``batches`` as in ``encrypt_table``."""
    return sink_csv(encrypt_table(df, key, method, partitions=partitions, slice_column=slice_column, batches=batches), folder, source_name)


def read_csv_sink(spark: SparkSession, path: str, schema, multi_line: bool = False, missing: str = MISSING) -> DataFrame:
    """Read a CSV sink. ``multi_line`` is for plain text cells with line breaks; it makes the
    files unsplittable. Tokens never need it."""
    rows = spark.read.schema(schema).csv(path, header=True, escape='"', multiLine=multi_line, nullValue=missing, emptyValue="")
    return rows.select(*[
        (F.when(F.startswith(cell(f.name), F.lit("\\")), F.substring(cell(f.name), 2, 2**31 - 1)).otherwise(cell(f.name)) if isinstance(f.dataType, T.StringType) else cell(f.name)).alias(f.name)
        for f in rows.schema
    ])
