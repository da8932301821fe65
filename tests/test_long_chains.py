"""cbc and fernet cells of many rows in one chain; sizes of tokens; tables whose tokens are stored in waves."""

import base64
import random
import uuid

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sealframe import session
from sealframe.functions import batches
from sealframe.functions.keyring import KEY_ID, KeyRing
from sealframe.functions.keys import with_key
from sealframe.functions.tokens import try_token_bytes
from sealframe.operators.cipher import decrypt_table, encrypt_table, open_cells, seal_cells
from sealframe.operators.integrity import tamper_report, token_size_report
from sealframe.session import shared_folder

METHODS = ["cbc", "fernet"]


def stored(frame):
    path = f"{shared_folder(frame.sparkSession)}/tokens"
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def awkward(spark):
    """More cells than a call takes; nulls, empty texts, texts around whole blocks, long ones and others than ASCII."""
    lengths = F.pmod(F.col("id") * 7, F.lit(36)).cast("int")
    return spark.range(0, 6000, 1, 1).select(
        F.when(F.col("id") % 11 != 0, F.repeat(F.lit("x"), lengths)).alias("a"), F.repeat(F.lit("\u00e9\u20ac"), lengths % 9).alias("b c"),
        F.when(F.col("id") % 1000 == 1, F.repeat(F.lit("long "), 3000)).alias("c"), F.lit(None).cast("string").alias("d"))


@pytest.mark.parametrize("method", METHODS)
def test_each_way_opens_the_other(spark, key, method):
    frame = stored(awkward(spark))
    for made, opened in ((True, False), (False, True), (True, True)):
        tokens = stored(encrypt_table(frame, key, method, partitions=2, long_chains=made))
        assert rows(decrypt_table(tokens, key, method, long_chains=opened)) == rows(frame)
        lengths = [F.sum(F.length(c)).alias(c) for c in ("a", "`b c`", "c")]
        assert tokens.agg(*lengths).first() == stored(encrypt_table(frame, key, method)).agg(*lengths).first()


@pytest.mark.parametrize("method", METHODS)
def test_rows_share_a_call_of_the_cipher(spark, key, method):
    frame = spark.createDataFrame([("x",) * 20], ", ".join(f"c{i} string" for i in range(20)))
    tokens = encrypt_table(frame, key, method, long_chains=True)
    opened = decrypt_table(tokens, key, method, long_chains=True)
    plan = opened._jdf.queryExecution().analyzed().toString()
    assert (plan.count("aes_encrypt"), plan.count("aes_decrypt")) == (1, 1) and opened.first() == frame.first()
    plan = opened._jdf.queryExecution().toString()
    for form in (key.hex(), key[16:].hex(), base64.b64encode(key).decode().rstrip("=")[:20]):
        assert form.lower() not in plan.lower()


def test_no_iv_comes_twice(spark, key):
    tokens = stored(encrypt_table(spark.range(0, 9000, 1, 2).select(F.lit("same").alias("x")), key, "cbc", long_chains=True))
    assert tokens.distinct().count() == 9000


def test_changed_tokens_are_counted_and_refused(spark, key):
    tokens = [r.x for r in encrypt_table(spark.range(60).select(F.col("id").cast("double").alias("x")), key, "fernet", long_chains=True).collect()]
    flip = lambda t, at: t[:at] + ("B" if t[at] == "A" else "A") + t[at + 1:]
    broken = [flip(t, 7 * i % (len(t) - 4)) for i, t in enumerate(tokens[:40])] + ["", "not base64!", tokens[0][:-4], tokens[0][:-1], "AAAA"]
    mixed = spark.createDataFrame([(t,) for t in broken + tokens[45:] + [None]], "x string")
    for way in (False, True):
        report = tamper_report(mixed, key, "fernet", long_chains=way).first()
        assert (report.cells, report.bad_cells) == (60, 45)
    for token in (*broken[::9], ""):
        with pytest.raises(PySparkException):
            decrypt_table(spark.createDataFrame([(token,)], "x string"), key, "fernet", long_chains=True).collect()
    with pytest.raises(PySparkException, match="HMAC"):
        decrypt_table(spark.createDataFrame([(tokens[0],)], "x string"), bytes(32), "fernet", long_chains=True).collect()
    plain = [r.x for r in encrypt_table(spark.range(3).select(F.lit("x" * 20).alias("x")), key, "cbc", long_chains=True).collect()]
    for bad in ([flip(plain[0], 43), plain[1]], [plain[0], plain[1][:-4]], [plain[0], "AAAA"]):
        with pytest.raises(PySparkException):
            decrypt_table(spark.createDataFrame([(t,) for t in bad], "x string").coalesce(1), key, "cbc", long_chains=True).collect()


@pytest.mark.parametrize("method", METHODS)
def test_keys_of_slices_and_rings(spark, key, method):
    keys = {"a": b"k" * 32, "b": b"l" * 32}
    frame = spark.createDataFrame([("a", "one"), ("b", "two"), ("a", None), ("b", "")], "s string, t string").coalesce(1)
    tokens = stored(encrypt_table(frame, keys, method, slice_column="s", long_chains=True))
    ring = KeyRing(spark, shared_folder(spark), key, 4)
    ringed = stored(encrypt_table(frame, ring, method, slice_column="s", partitions=2, long_chains=True))
    assert ringed.select(KEY_ID).distinct().count() > 1
    for way in (False, True):
        assert rows(decrypt_table(tokens, keys, method, slice_column="s", long_chains=way)) == rows(frame)
        assert rows(decrypt_table(ringed, ring, method, long_chains=way)) == rows(frame)
    if method == "fernet":
        assert [tuple(r) for r in tamper_report(tokens.withColumn("s", F.lit("a")), keys, method, slice_column="s", long_chains=True).collect()] == [("t", 3, 2)]


def test_other_columns_stay_and_gcm_is_refused(spark, key):
    frame = spark.sql("SELECT 'x' AS t, TIMESTAMP'2020-01-02 03:04:05' AS `a.b`, 1.5BD AS n, array('q', null) AS l")
    made = stored(seal_cells(with_key(frame, key), {"t": F.col("t")}, "fernet", ["a.b", "n", "l"], long_chains=True))
    assert open_cells(with_key(made, key), ["t"], "fernet", ["a.b", "n", "l"], long_chains=True).first() == frame.first()
    assert encrypt_table(frame.select("t").where("t = 'y'"), key, "cbc", long_chains=True).count() == 0
    nothing = spark.createDataFrame([(None,), (None,)], "t string").coalesce(1)
    assert rows(decrypt_table(encrypt_table(nothing, key, "cbc", long_chains=True), key, "cbc", long_chains=True)) == [(None,), (None,)]
    for job in (encrypt_table, decrypt_table, tamper_report):
        with pytest.raises(ValueError, match="batches"):
            job(frame.select("t"), key, "gcm", long_chains=True)


def test_sizes_of_odd_texts(spark):
    """Shapes are matched in workers, where only what Java's expression took counts: a line end is allowed before the end."""
    odd = ["abcd", "ab==", "abc=", "a===", "abc", "", "====", "ab d", "ab+d", "\u00e9\u00e9ab", "abc\n", "ab\r\n", "abc\u2028", "abc\u0085", "ab\n\n", "ab\nd", "\nabc", None, "-_-_" * 30]
    frame = spark.createDataFrame([(t, 12) for t in odd], "`a.b` string, n int").repartition(3)
    shape = "^[A-Za-z0-9_-]+={0,2}$"
    formed = frame.agg(F.count_if(F.rlike(F.col("`a.b`"), F.lit(shape)) & (F.length("`a.b`") % 4 == 0))).first()[0]
    assert [tuple(r) for r in token_size_report(frame.select("`a.b`")).collect()] == [("a.b", 18, 0, 120, sum(len(t or "") for t in odd), formed)] and formed == 8
    assert [tuple(r) for r in token_size_report(frame.select("`a.b`").where("false")).collect()] == [("a.b", 0, None, None, 0, 0)]
    bad = spark.sql("SELECT CAST(b AS STRING) AS t FROM VALUES (X'41C3'), (X'80808041'), (X'F5E282'), (X'F09F9880'), (X'C041E2') AS v(b)")
    row = token_size_report(bad).first()
    assert (row.shortest, row.longest, row.characters) == tuple(bad.agg(F.min(F.length("t")), F.max(F.length("t")), F.sum(F.length("t"))).first())
    plan = token_size_report(frame.select("`a.b`"))._jdf.queryExecution().toString()
    assert "RLIKE" not in plan and "MapInArrow" in plan


def test_tokens_are_decoded_as_spark_does(spark):
    """In workers, whole batches at a time where they are as written; of odd ones the same is taken and refused."""
    made = random.Random(7)
    parts = ["ABcd-_", "AB+/-_", "AB=", "AB= ", "AB \n\t\r", "AB\x0b\x0c\x1c\x85\u2003\xa0", "AB\u00e9", "AB*"]
    odd = ["".join(made.choices(made.choice(parts) + "QRST", k=made.randrange(14))) + made.choice(["", "", "=", "==", "===", "\n", "= ", "=\n="]) for _ in range(2000)]
    usual = [base64.urlsafe_b64encode(made.randbytes(made.randrange(9))).decode() for _ in range(50)] + [None]
    for texts in (odd, usual, odd[:40] + usual, ["QUJD"] * 3, ["QQ=="] * 3, [None], []):
        frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).orderBy("i")
        tokens = pa.array(texts, pa.string())
        assert [r[0] for r in frame.select(try_token_bytes(F.col("t"))).collect()] == batches._decoded(tokens, True).to_pylist()
        strict = F.try_to_binary(F.translate("t", "-_", "+/"), F.lit("base64"))
        for text, found in zip(texts, frame.select(strict).collect()):
            try:
                got = batches._decoded(pa.array([text], pa.string()), False)[0].as_py()
            except ValueError:
                got = None
            assert got == found[0], text
    assert batches._encoded(pa.array([None, b"", b"a", b"\xfb\xff", b"abc"], pa.binary())).to_pylist() == [None, "", "YQ==", "-_8=", "YWJj"]


def bytes_below(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


@pytest.mark.parametrize("name", ["encrypt_fernet", "tamper_report_fernet"])
def test_tokens_of_a_wave_at_a_time(spark, tmp_path, monkeypatch, name):
    """The tokens of whole tables filled the disk; now those of a wave are gone before the next, and every row is in one."""
    flags, status = F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")), F.when(F.col("id") % 2 == 0, "O").otherwise("F")
    frame = spark.range(0, 3000, 1, 3).select(
        (F.col("id") % 50).cast("double").alias("l_quantity"), F.when(F.col("id") % 7 > 0, F.col("id") / 7).alias("l_extendedprice"),
        F.lit(0.5).alias("l_discount"), F.lit(0.25).alias("l_tax"), flags.alias("l_returnflag"), status.alias("l_linestatus"))
    frame.unionByName(frame).write.parquet(str(tmp_path / "in" / "lineitem.parquet"))
    for module in (entry, session):
        monkeypatch.setattr(module, "shared_folder", lambda spark: f"{(tmp_path / 'shared').as_uri()}/{uuid.uuid4().hex}")
    seen = []

    def noted(operator):
        def run(*given, **more):
            seen.append(bytes_below(tmp_path / "shared"))
            return operator(*given, **more)
        return run

    for operator in ("tamper_report", "token_size_report"):
        monkeypatch.setattr(entry, operator, noted(getattr(entry, operator)))
    monkeypatch.setattr(entry, "CELLS_A_WAVE", 10**9)
    whole = rows(entry.queries()[name](spark, str(tmp_path / "in")))
    assert len(seen) == 1 and {r[0]: r[1] for r in whole}["l_extendedprice"] == 6000 - 2 * 429
    monkeypatch.setattr(entry, "CELLS_A_WAVE", 6000)
    assert rows(entry.queries()[name](spark, str(tmp_path / "in"))) == whole
    assert len(seen) >= 6 and max(seen[1:]) < 0.5 * seen[0] and bytes_below(tmp_path / "shared") < 0.1 * seen[0]
