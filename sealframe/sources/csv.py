"""Comma-separated measurement files with a pinned schema."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sealframe.layout import Layout


def scan_csv(spark: SparkSession, path: str | list[str], layout: Layout) -> DataFrame:
    """Files that all start with a header line.

    Spark's permissive rules apply: a malformed measure is null, a short row is filled with
    nulls, extra fields are dropped, blanks around the category are kept.
    """
    return spark.read.schema(layout.schema).csv(path, header=True)


def scan_csv_headerless(spark: SparkSession, path: str | list[str], layout: Layout, open_file: Callable[[str], IO[bytes]] | None = None) -> DataFrame:
    """Files with or without a header line, told apart file by file, in any codec and store that Spark reads.

    A first line that starts with the first column name, in any case and after blanks, is a
    header. All files are scanned once as if they had one, and the first lines that were none are
    added from a reading of only the beginning of each file. ``open_file`` may open a path in another way. Use
    ``scan_csv`` where all files are known to have headers.
    """
    first = first_lines(spark, path, open_file)
    is_header = F.rlike("first", F.lit(rf"(?iU)^\s*\Q{layout.columns[0]}\E"))
    # The scan leaves out the first line that is not blank, whether or not it is the first.
    bare = first.where(~is_header & F.col("line").isNotNull()).select(F.from_csv("line", layout.ddl).alias("row")).select("row.*")
    return spark.read.schema(layout.schema).csv(path, header=True).unionByName(bare)


# What the CSV reader trims before it calls a line blank, codecs (by ending) whose beginning Arrow
# inflates, and those that only Spark's readers know.
BLANKS = bytes(range(0x21))
CODECS = {"gz": "gzip", "bz2": "bz2", "zst": "zstd", "zstd": "zstd"}
OTHER_CODECS = ("deflate", "snappy", "lz4", "xz", "zz")
# Names that Spark has for stores that Arrow calls otherwise.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}
# Bytes of a file that are asked for at once while its first line is looked for.
CHUNK = 65_536


def first_lines(spark: SparkSession, path: str | list[str], open_file: Callable[[str], IO[bytes]] | None = None) -> DataFrame:
    """The ``first`` line of every file and the first ``line`` that is not blank; files without lines may have no row, or nulls.

    Where Arrow has the store and the codec, only the beginning of a file is read. Files in other stores (``viewfs`` and whatever else is
    set up for Spark alone) or codecs go through Spark's line reader instead, which reads them whole, in the scan's own way.
    """
    files = spark.read.format("binaryFile").load(path).select("path")  # listed, not read
    other = F.rlike("path", F.lit(rf"\.({'|'.join(OTHER_CODECS)})$"))
    if not open_file and not _reached(path):
        return _through_spark(spark, path)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                with (open_file or _open)(name) as file:
                    found.append(_first_lines(file))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)] if found else [pa.array([], pa.string())] * 2, names=["first", "line"])

    if open_file:
        return files.mapInArrow(begin, "first string, line string")
    plainly = files.where(~other).mapInArrow(begin, "first string, line string")
    return plainly.unionByName(_through_spark(spark, path, OTHER_CODECS)) if not files.where(other).isEmpty() else plainly


def _reached(path: str | list[str]) -> bool:
    """Whether Arrow has the file systems of all paths; a path without a scheme is in Spark's default store."""
    from pyarrow.fs import FileSystem

    for one in [path] if isinstance(path, str) else path:
        scheme = one.split(":", 1)[0] if re.match("[A-Za-z][A-Za-z0-9+.-]*:", one) else "file"
        try:
            if scheme != "file":
                FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{one.split(':', 1)[1]}")
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
            return False
    return True


def _open(path: str) -> IO[bytes]:
    """The inflated bytes of a file; of a codec only as much is inflated as is read."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    scheme, rest = path.split(":", 1)
    system, place = (LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    return system.open_input_stream(place, compression=CODECS.get(path.rsplit(".", 1)[-1].lower()), buffer_size=0)


def lines_of(file: IO[bytes]) -> Iterator[bytes]:
    """The lines of a file, ended by a line feed, a carriage return or both."""
    held, ended = [], False  # pieces of a line, and whether the last byte was a carriage return that ended one
    while chunk := file.read(CHUNK):
        if ended and chunk[:1] == b"\n":
            chunk = chunk[1:]
        ended = chunk[-1:] == b"\r"
        *whole, rest = re.split(rb"\r\n|\n|\r", chunk)
        for line in whole:
            yield b"".join([*held, line])
            held = []
        held.append(rest)
    if any(held):
        yield b"".join(held)


def _first_lines(file: IO[bytes]) -> tuple[str | None, str | None]:
    first = None
    for line in lines_of(file):
        text = line.decode("utf-8", "replace")
        first = text if first is None else first
        if line.strip(BLANKS):
            return first, text
    return first or "", None


def _through_spark(spark: SparkSession, path: str | list[str], endings: tuple[str, ...] | None = None) -> DataFrame:
    """The same from a scan of all lines, of files with one of the endings.

    A task's rows have rising numbers, so a file's first line has the smallest of its first block. Only numbers are gathered,
    map-side first, two for each file; the lines themselves are picked in a second scan.
    """
    at, text = F.monotonically_increasing_id(), F.col("value")
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), at.alias("at"))
    rows = rows.where(F.col("start") == 0)
    if endings:
        rows = rows.where(F.rlike("file", F.lit(rf"\.({'|'.join(endings)})$")))
    blank = F.rlike(text, F.lit(r"^[\x00-\x20]*$"))
    found = rows.groupBy("file").agg(F.min("at").alias("first"), F.min(F.when(~blank, F.col("at"))).alias("line"))
    places = found.select("file", F.explode(F.array(F.struct(F.lit(True).alias("is_first"), F.col("first").alias("place")),
                                                    F.struct(F.lit(False).alias("is_first"), F.col("line").alias("place")))).alias("one")).select(
        F.col("file").alias("of"), "one.*")
    picked = rows.join(places, F.col("at") == F.col("place"))
    return picked.groupBy("of").agg(F.max(F.when(F.col("is_first"), text)).alias("first"), F.max(F.when(~F.col("is_first"), text)).alias("line")).select("first", "line")
