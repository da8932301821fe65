"""The SQL beside the queries, on rows that the given tables do not have."""

import math
import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check_oracles import compare
from sealframe.llm.queries import oracle_sql, queries
from test_quality_rules import TEXTS

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, tmp_path, **rows):
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/parts-{name}")
        part = next(Path(f"{tmp_path}/parts-{name}").glob("*.parquet"))
        part.rename(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def same(spark, folder, *names):
    for name in names:
        assert compare(spark, folder, name, queries()[name], oracle_sql()[name]) == ""


def odd_documents():
    texts = [*TEXTS, "one two\r\nthree\x0cfour five\x0bsix\r\n", "a\rb\rc a\rb\rc " * 20, "A. b, A. b! c\x0cA b", "The end. the END" * 40, " " * 50]
    return [(i, t, [None, "en", "xx", ""][i % 4], [None, "src0", "s"][i % 3], None) for i, t in enumerate([*texts, *texts[3:9]])] + [(None, "a b c d e f", "en", "src1", 1)] * 2


def test_odd_texts(spark, tmp_path):
    labels = [(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, 0)]
    folder = tables(spark, tmp_path, documents=(DOCUMENTS, odd_documents()), labels=("doc_id bigint, quality int, toxic int", labels))
    same(spark, folder, "op2_source_mix", "op5_ngram_jaccard", "op8_quality_rules", "op12_collocations")


def test_very_rare_sources(spark, tmp_path):
    """A source that has to be repeated more than a thousand times."""
    rows = [(i, "x" * 999, "en", "big", 999) for i in range(60)] + [(100, "abcd" * 4, "en", "src0", 16), (101, "", "en", "src3", 0), (102, None, "en", "src1", 0)]
    folder = tables(spark, tmp_path, documents=(DOCUMENTS, rows))
    assert queries()["op2_source_mix"](spark, folder).where("doc_id = 101").count() > 1000
    same(spark, folder, "op2_source_mix")


def test_common_phrases(spark, tmp_path):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(["the", "The", "of", "a.", "b", "é", "c,\td"], k=80)), draw.choice(["en", None, "und"]), "s", None) for i in range(200)]
    same(spark, tables(spark, tmp_path, documents=(DOCUMENTS, rows)), "op12_collocations")


def test_odd_vectors(spark, tmp_path):
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0.1, 0.4) for _ in range(4)], draw.randrange(3)) for i in range(350)]
    rows += [rows[100], rows[100], (200, None, 1), (300, [1.0, None, 1.0, 1.0], 1), (None, rows[0][1], 1), (400, [math.nan] * 4, 1), (500, rows[1][1], None), (600, [], 1), (700, [], 1), (701, [], 2),
             (800, [math.inf, 0.0, 0.0, 0.0], 0), (900, [0.5, 0.5], 1), (901, [0.25, 0.25], 2), (902, [0.5, 0.25], 1), (-100, rows[4][1], 1), (-7, rows[5][1], 2)]
    folder = tables(spark, tmp_path, embeddings=("vec_id bigint, embedding array<float>, label int", rows))
    same(spark, folder, "op4_exact_top_k", "op11_hard_negatives")


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1, "u", "x"), (1, "u", "x"), (None, "v", "x"), (0, None, "x"), (2, "w", None), (3, "w", ""), (5, "http://h/p\n", "é" * 70_000)]])
def test_odd_pages(spark, tmp_path, rows):
    same(spark, tables(spark, tmp_path, pages=("page_id bigint, url string, html string", rows)), "op6_url_filters", "op13_warc")


def test_empty_tables(spark, tmp_path):
    folder = tables(spark, tmp_path, documents=(DOCUMENTS, []), labels=("doc_id bigint, quality int, toxic int", []), embeddings=("vec_id bigint, embedding array<float>, label int", []))
    same(spark, folder, "op4_exact_top_k", "op5_ngram_jaccard", "op8_quality_rules", "op11_hard_negatives", "op12_collocations")
