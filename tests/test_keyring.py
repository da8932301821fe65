"""Stored data keys: enough of them, counted, wrapped, and of use wherever a key is."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sealframe.functions.keyring import KEY_ID, KeyRing
from sealframe.layout import Layout
from sealframe.operators.cipher import decrypt_table, encrypt_table
from sealframe.operators.integrity import tamper_report
from sealframe.operators.places import seal_in_place
from sealframe.plans.flows import Target, run_encrypted
from sealframe.session import shared_folder
from sealframe.sinks.csv import read_csv_sink, sink_csv_encrypted
from sealframe.sinks.tables import sink_table_encrypted


@pytest.fixture
def ring(spark):
    return KeyRing(spark, shared_folder(spark), os.urandom(32), most=1000)


@pytest.fixture
def frame(spark):
    """One hot slice, some small ones and rows without one."""
    slice_ = F.when(F.col("id") < 3000, "hot").when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "")
    return spark.range(0, 3300, 1, 6).select((F.col("id") / 4).alias("x"), slice_.alias("s"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def kept(df):
    path = f"{shared_folder(df.sparkSession)}/kept"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("method", ["gcm", "cbc", "fernet"])
def test_round_trip_over_several_keys(frame, ring, method):
    tokens = kept(encrypt_table(frame, ring, method, slice_column="s"))
    assert rows(decrypt_table(tokens, ring, method, ["x"])) == rows(frame)
    per_slice = {r["slice"]: r.n for r in ring.keys().groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert per_slice == {"=hot": 9, "=a": 1, "=": 1, "null": 1}
    used = {r.key_id: r.cells for r in ring.usage(tokens).collect()}
    assert len(used) == 12 and max(used.values()) <= 1000 and sum(used.values()) == 3300 * 2 - 100
    assert {(r["slice"], r.epoch, r.cells) for r in ring.uses().collect()} == {("=hot", 1, 6000), ("=a", 1, 200), ("=", 1, 200), ("null", 1, 200)}


def test_epochs(frame, ring, spark):
    """Room is used up before new keys are made; old tokens stay readable."""
    some = frame.where("s = 'a'")
    first = kept(encrypt_table(some, ring, slice_column="s"))
    second = kept(encrypt_table(some, ring, slice_column="s"))
    assert ring.keys().count() == 1
    more = [kept(encrypt_table(some, ring, slice_column="s")) for _ in range(3)]
    assert rows(ring.keys().select("slice", "epoch", "part")) == [("=a", 1, 0), ("=a", 2, 0)]
    everything = first.unionByName(second)
    for part in more:
        everything = everything.unionByName(part)
    assert rows(decrypt_table(everything, ring, "gcm", ["x"])) == sorted(rows(some) * 5, key=repr)
    assert {r.key_id for r in first.collect()} != {r.key_id for r in more[-1].collect()}
    assert all(r.cells <= 1000 for r in ring.usage(everything).collect())


def test_refused_beyond(frame, ring, spark):
    """A ring that may not grow refuses what its keys have no room for, before anything is sealed, and counts failed attempts."""
    some = frame.where("s = 'a'")
    with pytest.raises(ValueError, match="no key has room.*=a"):
        encrypt_table(some, KeyRing(spark, ring.folder, ring.master, 1000, grow=False), slice_column="s")
    encrypt_table(some, ring, slice_column="s")
    fixed = KeyRing(spark, ring.folder, ring.master, 1000, grow=False)
    for _ in range(2):
        encrypt_table(some, fixed, slice_column="s")  # announced, never run
    with pytest.raises(ValueError, match="at most 1000 cells a key"):
        encrypt_table(some, fixed, slice_column="s")


def test_keys_are_wrapped(frame, ring, spark):
    tokens = kept(encrypt_table(frame.where("s = 'a'"), ring, slice_column="s"))
    bare = ring._bare(ring.keys(), "k").select("k.whole").first()[0]
    assert len(bare) == 32 and bare.hex() not in str(ring.keys().collect())
    other = KeyRing(spark, ring.folder, os.urandom(32), 1000)
    with pytest.raises(PySparkException, match="Tag mismatch|AES"):
        decrypt_table(tokens, other).collect()
    # A wrapped key does not pass for another one.
    twice = kept(encrypt_table(frame.where("s = 'hot'"), ring, slice_column="s"))
    swapped = ring.keys().withColumn(KEY_ID, F.reverse(KEY_ID))
    with pytest.raises(PySparkException, match="Tag mismatch|AES"):
        ring._bare(swapped, "k").collect()
    with pytest.raises(PySparkException, match="no key unheardof"):
        decrypt_table(twice.withColumn(KEY_ID, F.lit("unheardof")), ring).collect()
    plan = decrypt_table(tokens, ring)._jdf.queryExecution().toString()
    assert bare.hex() not in plan.lower() and ring.master.hex() not in plan.lower()


def test_sinks_check_and_job_take_it(frame, ring, spark):
    folder = shared_folder(spark)
    path = sink_csv_encrypted(frame, folder, "a.csv", ring, slice_column="s")
    tokens = read_csv_sink(spark, path, f"x string, s string, {KEY_ID} string")
    assert rows(decrypt_table(tokens, ring, "gcm", ["x"])) == rows(frame)
    table = spark.table(sink_table_encrypted(frame, "ring_checks", "t", ring, slice_column="s", location=folder))
    assert {r["column"]: (r.cells, r.bad_cells) for r in tamper_report(table, ring).collect()} == {"x": (3300, 0), "s": (3200, 0)}
    flipped = table.withColumn("x", F.overlay("x", F.when(F.substring("x", 20, 1) == "A", "B").otherwise("A"), F.lit(20)))
    assert {r["column"]: r.bad_cells for r in tamper_report(flipped, ring).collect()} == {"x": 3300, "s": 0}
    stored = run_encrypted(frame, Layout(("x",), "s"), "hot", Target("ring_checks", "job", folder, "b.csv"), ring)
    assert stored.count == 3000 and rows(stored.rows) == rows(frame.where("s = 'hot'")) and KEY_ID in stored.at_rest.columns
    assert stored.ranges == {"x": (0.0, 749.75)} and stored.measured.agg(F.max("x")).first()[0] == 749.75


def test_edges(ring, spark, frame):
    empty = spark.createDataFrame([], "x double, s string")
    assert decrypt_table(kept(encrypt_table(empty, ring, slice_column="s")), ring).count() == 0
    assert rows(decrypt_table(kept(encrypt_table(frame.limit(5).coalesce(1), ring)), ring, "gcm", ["x"])) == rows(frame.limit(5))
    with pytest.raises(ValueError, match="taken"):
        encrypt_table(spark.createDataFrame([("a",)], f"{KEY_ID} string"), ring)
    with pytest.raises(TypeError, match="places"):
        seal_in_place(frame, ring, ["x"], "t")


def test_rows_of_a_key_are_neighbours(spark):
    """Dealt to partitions, rows lie by their keys, of which a partition has few; opened ones too. A task that meets many keys in turn sets each up for a row or two."""
    ring = KeyRing(spark, shared_folder(spark), os.urandom(32), most=1000)
    frame = spark.range(0, 12000, 1, 6).select((F.col("id") / 4).alias("x"), F.when(F.col("id") % 2 == 0, "a").alias("s"))
    tokens = encrypt_table(frame, ring, partitions=4, slice_column="s", batches=True).withColumn("p", F.spark_partition_id())
    in_order = [list(map(tuple, part)) for part in tokens.select("p", KEY_ID).rdd.glom().collect()]
    changes = sum(a != b for part in in_order for a, b in zip(part, part[1:]))
    pairs = len({row for part in in_order for row in part})
    assert 36 <= pairs <= 2 * 36 + 8 and changes == pairs - 4
    assert all(2000 < len(part) < 4000 for part in in_order)
    mixed = kept(encrypt_table(frame, ring, slice_column="s").repartition(3))
    opened = [[row.k for row in part] for part in ring.keyed(mixed, None, "key").select(F.col(KEY_ID).alias("k")).rdd.glom().collect()]
    assert all(sum(a != b for a, b in zip(part, part[1:])) == len(set(part)) - 1 for part in opened if part)


def test_one_key_goes_to_all_partitions(spark):
    ring = KeyRing(spark, shared_folder(spark), os.urandom(32))
    frame = spark.range(0, 8000, 1, 1).select(F.col("id").alias("x"))
    tokens = encrypt_table(frame, ring, partitions=8, batches=True)
    assert all(700 < len(part) < 1300 for part in tokens.rdd.glom().collect()) and ring.keys().count() == 1


def test_rows_of_many_cells_keep_within_a_key(spark):
    """A row's cells come to one key together, so keys differ by more than they would with single cells."""
    ring = KeyRing(spark, shared_folder(spark), os.urandom(32), most=2000)
    frame = spark.range(0, 8000, 1, 4).select(*[F.col("id").alias(f"c{i}") for i in range(20)])
    used = [r.cells for r in ring.usage(kept(encrypt_table(frame, ring, partitions=4, batches=True))).collect()]
    assert sum(used) == 160_000 and max(used) <= 2000
    assert all(KeyRing(spark, "", b"", most).room(n) + 8 * (n * KeyRing(spark, "", b"", most).room(n)) ** 0.5 <= most for most in (20_000, 1 << 32) for n in (1, 5, 100))
