"""Measures against plain Python, the binomial bound against exact sums, calibrated verdicts."""

import collections
import math
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sealframe.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}" for i in range(30_000))
TEXTS = [None, "", " \n\t ", "a", "a a", "a a a", "a a a a a", "x y z x y z", "a b c d a b c e a b c", "l\nl\n\nl \n l", "#a *$%&|<>", "äöü €uro 😀 é",
         "p\x0bq\x0cr\rs", "a\u00a0b c", LONG, "a b\na b\nc", "t t t u t t t"]


def plain(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(documents):
    docs = documents(list(enumerate(TEXTS))).withColumn("n_words", F.lit("clash"))
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rules.measures(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("n,rate", [(40, 0.1), (400, 0.02), (3000, 0.004)])
def test_binomial_tail(spark, n, rate):
    def exact(k):
        p = Fraction(rate)
        return float(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))

    ks = range(0, min(n, 40))
    doubts = (0.2, 0.01, 1e-4)
    frame = spark.createDataFrame([(k, n) for k in ks], "k bigint, n bigint")
    for doubt in doubts:
        got = {r["k"]: r["ok"] for r in frame.select("k", rules.binomial_tail(F.col("k"), F.col("n"), rate, doubt).alias("ok")).collect()}
        assert got == {k: k < n * rate and exact(k) <= doubt for k in ks}


def test_binomial_tail_of_many(spark):
    """No underflow where every single term is far below the smallest double."""
    frame = spark.createDataFrame([(500, 2_000_000), (19_000, 2_000_000)], "k bigint, n bigint")
    got = [r["ok"] for r in frame.orderBy("k").select(rules.binomial_tail(F.col("k"), F.col("n"), 0.01, 1e-6).alias("ok")).collect()]
    assert got == [True, True]


def test_cutoffs_keep_good_documents(documents, spark):
    good = [(i, " ".join(f"w{i}x{j}" for j in range(80)), "en", "s") for i in range(3000)]
    bad = [(5000 + i, " ".join(f"w{i}x{j}{'%%%' if j % 2 else ''}" for j in range(80)), "en", "s") for i in range(50)]
    some = [(6000 + i, " ".join(f"v{i}x{j}" for j in range(80)) + " %", "xx", "s") for i in range(20)]
    docs = documents([*good, *bad, *some])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3000)] + [(5000, 0, 0), (None, 1, 0), (7, None, 0), (6000, 1, 0)], "doc_id bigint, quality int, toxic int")
    risk = rules.Risk()
    measured = rules.measures(docs)
    cutoffs = rules.calibrate(rules.labelled_rows(measured, labels), risk)
    assert {k for k in cutoffs} == {("en", r) for r in rules.rules()}  # too few labels elsewhere
    kept = {r["doc_id"]: r["kept"] for r in rules.verdicts(measured, cutoffs, risk).collect()}
    assert all(kept[i] for i in range(3000)) and all(kept[6000 + i] for i in range(20))
    assert not any(kept[5000 + i] for i in range(50))


def test_false_rejections_stay_below_the_share(documents, spark):
    """A fifth of the good documents have symbols: the cutoff has to leave them."""
    rows = [(i, " ".join(f"w{i}x{j}{'%%' if i % 5 == 0 and j % 3 == 0 else ''}" for j in range(60)), "de", "s") for i in range(2000)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2000)], "doc_id bigint, quality int, toxic int")
    measured = rules.measures(docs)
    cutoffs = rules.calibrate(rules.labelled_rows(measured, labels))
    assert all(r["kept"] for r in rules.verdicts(measured, cutoffs).collect())


def test_no_documents_and_no_labels(documents, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for rows in ([], [(1, "a b")]):
        measured = rules.measures(documents(rows))
        assert rules.calibrate(rules.labelled_rows(measured, labels)) == {}
        assert [r["kept"] for r in rules.verdicts(measured, {}).collect()] == [False] * len(rows)
