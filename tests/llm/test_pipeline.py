"""The stages against plain Python, each on its own input; the registered queries."""

import re
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from sealframe.llm import queries
from sealframe.llm.shared import read
from test_mixing import plain as plain_mix
from test_ngram_join import classes, grams
from test_quality_rules import plain as plain_measures

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into and comes out of every stage."""
    docs, out = read(spark, SF_DIR, "documents"), {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        out[name] = [tuple(r) for r in docs.collect()], spark.read.parquet(path)
        docs = out[name][1]
    return out


def test_order_and_columns(stages):
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "passages", "mixture", "packing"]
    for name, (_, out) in list(stages.items())[:-1]:
        assert out.columns == COLUMNS, name


def test_quality(spark, stages):
    before, after = stages["quality"]
    kept = Counter(tuple(r) for r in after.collect())
    verdicts = {r["doc_id"]: r["kept"] for r in queries.op8_quality_rules(spark, SF_DIR).collect()}
    assert kept == Counter(r for r in before if verdicts[r[0]])
    for r in kept:
        n, _, _, _, repeats = plain_measures(r[1])
        assert n >= 50 and 100 * repeats <= 50 * n


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    sets = [grams(r[1]) for r in before]
    order = sorted(range(len(before)), key=lambda i: before[i][0])
    label = classes([sets[i] for i in order])
    first = {}
    for i, c in zip(order, label):
        first.setdefault(c if sets[i] else ("alone", i), before[i])
    assert sorted(tuple(r) for r in after.collect()) == sorted(first.values())


def test_passages(stages):
    """No run of 50 words is left in two documents; what is there was there before."""
    before, after = stages["passages"]
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    old, seen = {r[0]: r for r in before}, {}
    for r in sorted(map(tuple, after.collect())):
        assert r[2:4] == old[r[0]][2:4] and (r == old[r[0]] or r[4] == len(r[1]))
        left, rest = words(r[1]), iter(words(old[r[0]][1]))
        assert left and all(w in rest for w in left)
        for i in range(len(left) - 49):
            assert seen.setdefault(tuple(left[i:i + 50]), r[0]) == r[0]


def test_mixture(stages):
    before, after = stages["mixture"]
    want = plain_mix([r[:4] for r in before], pipeline.WEIGHTS, pipeline.SEED)
    assert Counter((r["doc_id"], r["text"]) for r in after.collect()) == want


def test_packing(stages):
    before, after = stages["packing"]
    ids = Counter(r[0] for r in before)
    rows = after.collect()
    total = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert total.keys() == ids.keys()
    placed = Counter()
    for r in rows:
        placed[r["doc_id"]] += r["length"]
    assert placed == Counter({d: n * total[d] for d, n in ids.items()})


def test_run(spark, stages):
    assert pipeline.run(spark, SF_DIR).count() == stages["packing"][1].count()


@pytest.mark.parametrize("rows", [[], [(1, None), (None, None), (2, ""), (2, "")], [(i, "the same words " * 30, "en", "src0") for i in range(4)]])
def test_odd_tables_run_through(spark, documents, rows):
    docs = documents(rows)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs.collect()


def test_extra_columns_stay(spark, documents):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(5)]
    docs = documents(rows).selectExpr("*", "'a' as n_words", "'b' as copy", "'c' as tie", "'d' as node", "'e' as _words", "'f' as _id", "'g' as good")
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == [*COLUMNS, "n_words", "copy", "tie", "node", "_words", "_id", "good"] and docs.first()["tie"] == "c"


def test_queries_are_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, name):
    from check_oracles import compare

    assert compare(spark, SF_DIR, name, contract.queries()[name], contract.oracle_sql()[name]) == ""
