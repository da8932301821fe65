"""Cells of many rows in one call of the cipher: the tokens of the other way, both ways."""

import base64
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sealframe.functions import batches
from sealframe.functions.keyring import KeyRing
from sealframe.functions.keys import KEY, with_key
from sealframe.operators.cipher import decrypt_table, encrypt_table, open_cells, seal_cells
from sealframe.operators.integrity import tamper_report
from sealframe.session import shared_folder


def stored(frame):
    path = f"{shared_folder(frame.sparkSession)}/tokens"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def awkward(spark):
    """Texts of all lengths about some blocks, with nulls, over columns of odd names, in more calls than one."""
    draw = random.Random(5)
    rows = [tuple(None if draw.random() < 0.2 else "æ" * draw.randint(0, 2) + "t" * draw.randint(0, 70) for _ in range(3)) for _ in range(700)]
    rows += [(None,) * 3, ("",) * 3, ("x" * 100_000, "y" * 4095, None), ("long " * 600_000, 'quote " comma , line\nbreak', "z" * 16)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, `a.b` string, `c``d` string, t string").repartition(3)


@pytest.mark.parametrize("sealing,opening", [(True, False), (False, True), (True, True)])
def test_both_ways_make_and_open_the_same_tokens(spark, key, monkeypatch, sealing, opening):
    frame = awkward(spark)
    tokens = stored(encrypt_table(frame, key, batches=sealing))
    cells = [t for r in tokens.collect() for t in r if t is not None]
    assert len({base64.urlsafe_b64decode(t)[:12] for t in cells}) == len(cells)
    got = decrypt_table(tokens, key, "gcm", {"i": "int"}, batches=opening)
    assert got.columns == frame.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr)
    sizes = {r.column: r for r in tamper_report(tokens, key, batches=opening).collect()}
    assert {c: (sizes[c].cells, sizes[c].bad_cells) for c in frame.columns} == {c: (frame.where(F.col(f"`{c.replace('`', '``')}`").isNotNull()).count(), 0) for c in frame.columns}


@pytest.mark.parametrize("cells,text", [(1, 1), (7, 1 << 21), (1 << 14, 100)])
def test_batches_of_other_sizes(spark, key, monkeypatch, cells, text):
    """The cut of a batch, without Spark's part: all rows, in order, none cut."""
    import pyarrow as pa

    monkeypatch.setattr(batches, "CELLS", cells)
    monkeypatch.setattr(batches, "TEXT", text)
    keys = [b"k" * 32, b"l" * 32]
    rows = [(keys[i % 3 == 0], b"x" * (i * 37 % 90), None if i % 4 == 0 else b"y", i) for i in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.binary(), pa.binary(), pa.int32()))], names=["k", "a", "b", "i"])
    found = [(k, *r.values()) for k, b in batches._cut(batch, 2) for r in b.to_pylist()]
    assert sorted(found, key=lambda r: r[3]) == rows and [r for r in found if r[0] == keys[0]] == [r for r in rows if r[0] == keys[0]]
    for _, b in batches._cut(batch, 2):
        size = sum(len(x or b"") for r in b.to_pylist() for x in (r["a"], r["b"]))
        assert b.num_rows == 1 or (2 * b.num_rows <= cells and size <= text)


def test_hash_is_that_of_the_field():
    """Against the plain sum of products, bit by bit."""
    draw = random.Random(6)

    def times(x, y):
        found = 0
        for i in range(128):
            if x >> (127 - i) & 1:
                found ^= y
            y = y >> 1 ^ (batches.POLYNOMIAL if y & 1 else 0)
        return found

    texts = [draw.randbytes(n) for n in (0, 1, 15, 16, 17, 32, 33, 48, 100, 513, 0, 5)]
    element = draw.randbytes(16)
    import pyarrow as pa
    flat = batches._Flat([pa.array(texts, pa.binary())])
    part = batches._Part(flat.at, flat.size)
    got = batches._hashed(part.in_blocks(flat.bytes), part, element)
    for text, tag in zip(texts, got):
        blocks = [text[i:i + 16].ljust(16, b"\0") for i in range(0, len(text), 16)] + [(8 * len(text)).to_bytes(16)]
        y = 0
        for b in blocks:
            y = times(y ^ int.from_bytes(b), int.from_bytes(element))
        assert tag.tobytes() == y.to_bytes(16)


def test_rows_share_a_call_of_the_cipher(spark, key):
    """A call of each cell failed the tables of 216 M rows; here all cells of the table take one in the plan."""
    frame = spark.createDataFrame([("x",) * 8], ", ".join(f"c{i} string" for i in range(8)))
    tokens = encrypt_table(frame, key, batches=True)
    opened = decrypt_table(tokens, key, batches=True)
    for made, calls in ((tokens, 1), (opened, 2), (tamper_report(tokens, key, batches=True), 2)):
        plan = made._jdf.queryExecution().analyzed().toString()
        assert plan.count("aes_encrypt") == calls and "aes_decrypt" not in plan
    plan = opened._jdf.queryExecution().toString()
    for form in (key.hex(), base64.b64encode(key).decode().rstrip("=")[:20]):
        assert form.lower() not in plan.lower()


def test_changed_tokens_are_counted_and_refused(spark, key):
    tokens = [r.x for r in encrypt_table(spark.range(60).select(F.col("id").cast("double").alias("x")), key, batches=True).collect()]
    flip = lambda t, at: t[:at] + ("B" if t[at] == "A" else "A") + t[at + 1:]
    broken = [flip(t, 7 * i % (len(t) - 4)) for i, t in enumerate(tokens[:40])] + ["", "not base64!", tokens[0][:-4], tokens[0][:-1], "AAAA"]
    mixed = spark.createDataFrame([(t,) for t in broken + tokens[45:] + [None]], "x string")
    for way in (False, True):
        report = tamper_report(mixed, key, batches=way).first()
        assert (report.cells, report.bad_cells) == (60, 45)
    for token in (*broken[::9], ""):
        with pytest.raises(PySparkException):
            decrypt_table(spark.createDataFrame([(token,)], "x string"), key, batches=True).collect()
    with pytest.raises(PySparkException, match="tag"):
        decrypt_table(spark.createDataFrame([(tokens[0],)], "x string"), bytes(32), batches=True).collect()


def test_keys_of_slices_and_rings(spark, key):
    keys = {"a": b"k" * 32, "b": b"l" * 32}
    frame = spark.createDataFrame([("a", "one"), ("b", "two"), ("a", None), ("b", "")], "s string, t string").coalesce(1)
    tokens = stored(encrypt_table(frame, keys, slice_column="s", batches=True))
    for way in (False, True):
        assert sorted(map(tuple, decrypt_table(tokens, keys, slice_column="s", batches=way).collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr)
        assert [(r.column, r.cells, r.bad_cells) for r in tamper_report(tokens.withColumn("s", F.lit("a")), keys, slice_column="s", batches=way).collect()] == [("t", 3, 2)]
    ring = KeyRing(spark, shared_folder(spark), key, 4)
    tokens = stored(encrypt_table(frame, ring, slice_column="s", batches=True))
    assert tokens.select("key_id").distinct().count() > 1
    for way in (False, True):
        assert sorted(map(tuple, decrypt_table(tokens, ring, batches=way).collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr)


def test_other_columns_stay_and_other_methods_are_refused(spark, key):
    frame = spark.sql("SELECT 'x' AS t, TIMESTAMP'2020-01-02 03:04:05' AS `a.b`, DATE'2020-01-02' AS d, 1.5BD AS n, array('q', null) AS l")
    made = stored(seal_cells(with_key(frame, key), {"t": F.col("t")}, "gcm", ["a.b", "d", "n", "l"], batches=True))
    assert open_cells(with_key(made, key), ["t"], "gcm", ["a.b", "d", "n", "l"], batches=True).first() == frame.first()
    assert encrypt_table(frame.select("t").where("t = 'y'"), key, batches=True).count() == 0
    only = encrypt_table(frame.select("t"), {"x": key}, slice_column="t", batches=True)
    assert only.first().t == "x"
    for job in (encrypt_table, decrypt_table, tamper_report):
        with pytest.raises(ValueError, match="batches"):
            job(frame.select("t"), key, "fernet", batches=True)


def test_texts_that_are_no_texts_fail(spark, key):
    keyed = with_key(spark.createDataFrame([(bytearray(b"\xff\xfe"),)], "b binary"), key)
    tokens = seal_cells(keyed, {"t": F.col("b")}, "gcm", [], batches=True)
    assert KEY not in tokens.columns
    with pytest.raises(PySparkException, match="(?i)utf8"):
        decrypt_table(tokens, key, batches=True).collect()
