"""Data keys for each slice of a table, wrapped by one master key and stored beside the data.

One key should seal at most some 2**32 cells. A ring makes as many random data keys for each slice as its cells need, stores
them sealed under the master key, and writes down how many cells each slice is about to seal before any is sealed, so that
attempts that fail count too. Every sealed row names its key. New keys open a new epoch of their slice; older ones stay and open
what they have sealed.
"""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sealframe.functions.keys import KEY, key_parts, with_key
from sealframe.functions.text import cell
from sealframe.functions.tokens import open_bytes, seal, token_bytes
from sealframe.session import shared_folder

KEY_ID = "key_id"
MOST_CELLS = 1 << 32
# Fixed value: the bytes of each part of a key, in the order in which they are stored.
PARTS = {"whole": 32, "sealing": 16, "inner": 64, "outer": 64}
KEYS = "slice string, epoch int, part int, key_id string, wrapped string"
# Keys, of some 350 bytes each, that every executor gets; runs of rows of one key that a partition gets of a slice, at least.
SENT = 1 << 17
RUNS = 16
USES = "slice string, epoch int, cells bigint, fresh int"


@dataclass(frozen=True)
class KeyRing:
    """Stands where a key is asked for, when sealing and when opening. ``folder`` is shared; only one driver at a time may seal with it.

    ``most`` cells a key: what would go beyond gets new keys, or is refused where the ring may not ``grow``. The keys' table holds the
    slices' values in the clear and every key wrapped.
    """

    spark: SparkSession
    folder: str
    master: bytes
    most: int = MOST_CELLS
    grow: bool = True

    def room(self, cells: int) -> int:
        """Cells to count on for each key where a row has so many: rows are dealt to the keys of a slice by a hash, so one has a few more than
        another. Eight standard deviations of the rows more are still within ``most``."""
        return max(1, math.floor(cells * ((math.sqrt(64 + 4 * self.most / cells) - 8) / 2) ** 2))

    def keys(self) -> DataFrame:
        return self._stored("keys", KEYS)

    def uses(self) -> DataFrame:
        """Cells that have been announced, for each slice and epoch."""
        return self._stored("uses", USES).groupBy("slice", "epoch").agg(F.sum("cells").alias("cells"))

    def _stored(self, name: str, schema: str) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def reserve(self, df: DataFrame, slice_column: str | None, cells: int) -> None:
        """Announce ``cells`` cells for each row of ``df``; slices whose newest keys have no room for them get new ones.

        Counts the rows of each slice, map-side first: a pass over one column.
        """
        asked = df.groupBy(_slice(slice_column).alias("slice")).agg((F.count(F.lit(1)) * cells).alias("cells"))
        newest = self.keys().groupBy("slice", "epoch").agg(F.count(F.lit(1)).alias("parts")).groupBy("slice").agg(F.max(F.struct("epoch", "parts")).alias("newest"))
        used = self.uses().withColumnRenamed("cells", "used")
        state = asked.join(newest, "slice", "left").select("slice", "cells", "newest.*").join(used, ["slice", "epoch"], "left")
        room = self.room(max(1, cells))
        full = F.col("epoch").isNull() | (F.coalesce("used", F.lit(0)) + F.col("cells") > F.col("parts") * room)
        if not self.grow:
            refused = [r["slice"] for r in state.where(full).select("slice").limit(10).collect()]
            if refused:
                raise ValueError(f"no key has room for the cells of slices {refused}: at most {self.most} cells a key")
        fresh = F.when(full, F.ceil(F.col("cells") / room).cast("int")).otherwise(0)
        # To the store first, then the keys that it asks for.
        plan = f"{shared_folder(self.spark)}/plan"
        state.select("slice", F.when(full, F.coalesce("epoch", F.lit(0)) + 1).otherwise(F.col("epoch")).cast("int").alias("epoch"), "cells", fresh.alias("fresh")).write.parquet(plan)
        planned = self.spark.read.schema(USES).parquet(plan)
        planned.write.mode("append").parquet(f"{self.folder}/uses")
        self._make(planned.where("fresh > 0"))

    def _make(self, planned: DataFrame) -> None:
        def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names = [os.urandom(16).hex() for _ in range(batch.num_rows)]
                texts = [base64.b64encode(b"".join(key_parts(os.urandom(32)).values())).decode() for _ in names]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["slice", "epoch", "part", KEY_ID, "bare"])

        rows = planned.select("slice", "epoch", F.explode(F.sequence(F.lit(0), F.col("fresh") - 1)).alias("part"))
        made = with_key(rows.mapInArrow(drawn, f"slice string, epoch int, part int, {KEY_ID} string, bare string"), self.master)
        made.select("slice", "epoch", "part", KEY_ID, seal(F.col("bare"), F.col(KEY), "gcm", place=F.col(KEY_ID)).alias("wrapped")) \
            .write.mode("append").parquet(f"{self.folder}/keys")

    def _bare(self, keys: DataFrame, name: str) -> DataFrame:
        """The keys unwrapped. Spark sends so small a table to every executor, which are the places where cells are sealed anyway."""
        opened = F.unbase64(open_bytes(token_bytes(F.col("wrapped")), F.col(KEY), "gcm", place=F.col(KEY_ID)))
        fields, at = [], 1
        for part, size in PARTS.items():
            fields.append(F.substring(F.col("opened"), at, size).alias(part))
            at += size
        plain = with_key(keys, self.master).withColumn("opened", opened)
        return plain.select("slice", "epoch", "part", KEY_ID, F.struct(*fields).alias(name))

    def keyed(self, df: DataFrame, slice_column: str | None, name: str = KEY, partitions: int | None = None) -> DataFrame:
        """``df`` with each row's key: the one that it names, or one of its slice's newest, and then its name too.

        Rows of a key are neighbours in the result, so that those who take many rows at a time meet few keys. With ``partitions``, rows that
        get a key are dealt to so many partitions, of which each has a few of the keys only.
        """
        if KEY_ID in df.columns:
            stored = self.keys()
            keys = _sent(stored, self._bare(stored, name).select(F.col(KEY_ID).alias("__key_id"), name))
            found = df.join(keys, cell(KEY_ID) == F.col("__key_id"), "left").drop("__key_id").sortWithinPartitions(cell(KEY_ID))
            return found.withColumn(name, F.coalesce(name, _missing(F.lit("no key "), cell(KEY_ID), found.schema[name].dataType)))
        last = self.keys().groupBy("slice").agg(F.max("epoch").alias("last")).withColumnRenamed("slice", "of")
        newest = f"{shared_folder(self.spark)}/newest"  # wrapped; its size decides how it is joined
        self.keys().join(last, (F.col("slice") == F.col("of")) & (F.col("epoch") == F.col("last"))).select("slice", "epoch", "part", KEY_ID, "wrapped").write.parquet(newest)
        stored = self.spark.read.schema(KEYS).parquet(newest)
        keys = _sent(stored, self._bare(stored, name).select(F.col("slice").alias("__of"), F.col("part").alias("__of_part"), F.col(KEY_ID).alias("__id"), F.col(name).alias("__bare")))
        parts = stored.groupBy(F.col("slice").alias("__slice")).agg(F.count(F.lit(1)).alias("__parts"))
        # A task that is run again deals rows to the same keys and partitions, in whatever order it reads them.
        ordered = df if partitions is None else df.sortWithinPartitions(F.xxhash64(*[_hashable(f) for f in df.schema]))
        dealt = ordered.withColumn("__turn", F.xxhash64(F.monotonically_increasing_id())).join(parts, _slice(slice_column) == F.col("__slice"), "left")
        if partitions is not None:
            # Where a slice has few keys, the rows of each go to several partitions.
            runs = F.col("__parts") * F.ceil(F.lit(RUNS * partitions) / F.col("__parts"))
            dealt = dealt.repartitionById(partitions, (F.pmod("__turn", runs) % partitions).cast("int"))
        mine = (F.col("__slice") == F.col("__of")) & (F.pmod("__turn", "__parts") == F.col("__of_part"))
        found = dealt.join(keys, mine, "left").sortWithinPartitions("__id")
        bare = F.coalesce("__bare", _missing(F.lit("no key was reserved for a slice"), F.lit(""), found.schema["__bare"].dataType))
        return found.select(*map(cell, df.columns), F.col("__id").alias(KEY_ID), bare.alias(name))

    def usage(self, stored: DataFrame) -> DataFrame:
        """key_id and cells (null ones do not count) of a stored table, to be held against ``most``."""
        sealed = [c for c in stored.columns if c != KEY_ID]
        cells = sum((cell(c).isNotNull().cast("bigint") for c in sealed), F.lit(0))
        return stored.groupBy(KEY_ID).agg(F.sum(cells).alias("cells"))


def _sent(stored: DataFrame, keys: DataFrame) -> DataFrame:
    """``keys``, made from those ``stored``, sent to every executor where they are few: as strings and structs they look larger to Spark than they are."""
    return F.broadcast(keys) if stored.count() <= SENT else keys


def _hashable(field: T.StructField) -> Column:
    plain = T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType
    return cell(field.name) if isinstance(field.dataType, plain) else cell(field.name).cast("string")


def _missing(text: Column, more: Column, kind) -> Column:
    return F.raise_error(F.concat(text, F.coalesce(more, F.lit("")))).cast(kind)


def _slice(column: str | None) -> Column:
    """A slice's name: a null is one of its own, and without a column all rows are one."""
    return F.lit("") if column is None else F.coalesce(F.concat(F.lit("="), cell(column).cast("string")), F.lit("null"))
