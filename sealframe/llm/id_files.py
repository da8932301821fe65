"""Token-id files: whole texts as ids in ascending document order, coded in frames, and back.

A dataset is a Parquet table with one row per frame and one row group per row, so it lies in any store Spark writes to,
splits into frames, and a writer holds one frame. Columns: ``part`` and ``first`` (ids before the frame in its part; parts are in order),
``n_ids``, ``doc_ids`` and ``counts`` (per document, with the end id), ``symbols`` (the frequency
table) and ``blocks``. A frame closes at the end of a document after FRAME ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sealframe.llm import rans
from sealframe.llm.shared import partitions
from sealframe.llm.tokens import document_ids

FRAME = 4 << 20
FRAMES = ("part int, first bigint, n_ids bigint, doc_ids array<bigint>, counts array<int>, symbols binary, "
          "blocks array<struct<count:int,crc:bigint,states:binary,places:binary,words:binary>>")
DOCUMENTS = "part int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint"


def _frame(part: int, first: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    whole = np.concatenate(ids)
    table = rans.Table.of(whole)
    blocks = [rans.encode(whole[i:i + rans.BLOCK], table) for i in range(0, len(whole), rans.BLOCK)]
    block_type = pa.struct([("count", pa.int32()), ("crc", pa.int64()), ("states", pa.binary()), ("places", pa.binary()), ("words", pa.binary())])
    packed = [{"count": b.count, "crc": b.crc, "states": b.states.tobytes(), "places": b.places.tobytes(), "words": b.words.tobytes()} for b in blocks]
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(whole)], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
        pa.array([table.pack()], pa.binary()), pa.array([packed], pa.list_(block_type)),
    ], names=["part", "first", "n_ids", "doc_ids", "counts", "symbols", "blocks"])


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``path``; ``end`` follows each document's ids.

    A null text is empty. Null ids come first, documents with the same id in the order of their
    texts' hashes; rows that are equal in both are the same, so their order does not matter. An empty
    table writes no frame. A task holds one frame at a time (FRAME ids and the longest document).
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, size, doc_ids, ids = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), document_ids(batch.column(1), tokenizer, end)):
                doc_ids.append(doc_id)
                ids.append(found.copy())
                size += len(found)
                if size >= FRAME:
                    yield _frame(part, first, doc_ids, ids)
                    first, size, doc_ids, ids = first + size, 0, [], []
        if ids:
            yield _frame(part, first, doc_ids, ids)

    rows.select("doc_id", "text").mapInArrow(frames, FRAMES).write \
        .option("compression", "none").option("parquet.block.row.count.limit", 1).parquet(path)


def decode_frame(row: dict) -> Iterator[np.ndarray]:
    """The ids of each document of a frame."""
    table = rans.Table.unpack(row["symbols"])
    found = [rans.decode(rans.Block(
        b["count"], b["crc"], np.frombuffer(b["states"], "<u8").reshape(-1, rans.LANES), np.frombuffer(b["places"], "<i8"),
        np.frombuffer(b["words"], "<u4")), table) for b in row["blocks"]]
    whole = np.concatenate(found) if found else np.zeros(0, "<u4")
    ends = np.cumsum(row["counts"])
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        yield whole[a:b]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document."""
    frames = spark.read.schema(FRAMES).parquet(path)  # a task takes frames up to the size of Spark's partitions

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("part", "first", "doc_ids", "counts", "symbols", "blocks")}
                crcs = [zlib.crc32(np.ascontiguousarray(ids)) for ids in decode_frame(row)]
                counts = np.array(row["counts"], np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(crcs), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["first"] + np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64()),
                ], names=["part", "doc_id", "place", "n_tokens", "ids_crc32"])

    # One row per part of the writer, a number that its shuffle partitions bound.
    sizes = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    found = frames.mapInArrow(documents, DOCUMENTS)
    return found.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
