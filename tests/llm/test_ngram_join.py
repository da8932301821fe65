"""The join against all pairs, with small limits that force every path; components against union-find."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealframe.llm import ngram_join
from sealframe.llm.components import components
from sealframe.llm.ngram_join import Limit, jaccard_classes, one_per_component, region_links

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def classes(sets):
    """For each set the smallest number of its component; all pairs."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = sorted((label[i], label[j]), reverse=True)
                label = [new if x == old else x for x in label]
    return label


def texts(seed):
    """Groups of near copies with few and many edits, a passage that many share, short and odd texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randint(0, 4000)}"
    passage, out = " ".join(word() for _ in range(25)), []
    for _ in range(25):
        base = [word() for _ in range(draw.randint(8, 90))]
        for _ in range(draw.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = word()
            out.append(" ".join(copy[draw.choice([0, 0, 1, 3]):]))
    out += [" ".join([passage, *(word() for _ in range(draw.randint(1, 12)))]) for _ in range(60)]
    out += ["", None, " \n", "a", "A", "a b", "A  b", "a b c d", "a b c d e", "b a", out[0].upper(), out[0].replace(" ", "\n"), out[3], out[3], "É é x", "é é x"]
    return out


@pytest.mark.parametrize("seed,cell,flush", [(1, 400_000, 1_000_000), (2, 300, 1_000_000), (3, 60, 500)])
def test_against_all_pairs(documents, monkeypatch, seed, cell, flush):
    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "FLUSH", flush)
    rows = list(enumerate(texts(seed)))
    sets = [grams(t) for _, t in rows]
    want = [(i, len(s), c) for (i, _), s, c in zip(rows, sets, classes(sets))]
    got = jaccard_classes(documents(rows).withColumn("node", F.lit("clash"))).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_one_row_of_every_component_stays(documents):
    some = texts(4)
    rows = [*enumerate(some), (5, some[5]), (5, some[5]), (None, some[7]), (None, "only null ids have this text here"), (None, "only null ids have this text here"),
            (None, None), (None, None), (9000, ""), (9000, "")]
    docs = documents(rows).withColumn("component", F.lit(1))
    out = one_per_component(docs, jaccard_classes(docs))
    assert out.columns == docs.columns
    got = out.collect()
    sets = [grams(t) for _, t in rows]
    label = classes(sets)
    first = {}
    for (i, t), c, s in zip(rows, label, sets):
        if s:
            first[c] = min(first.get(c, (True, 0)), (i is None, i or 0))
    found = {}
    for r in got:
        s = grams(r["text"])
        if s:
            c = next(k for k, t in zip(label, sets) if t == s)
            assert c not in found
            found[c] = (r["doc_id"] is None, r["doc_id"] or 0)
    assert found == first
    assert sum(not grams(r["text"]) for r in got) == sum(not s for s in sets)


def test_repeated_ids_with_different_texts(documents):
    rows = [(1, "a b c d e f g h"), (1, "q r s t u v w x"), (2, "a b c d e f g h"), (3, "q r s t u v w x")]
    got = jaccard_classes(documents(rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 4, 1)]
    assert one_per_component(documents(rows), jaccard_classes(documents(rows))).count() == 2


def test_no_documents(documents):
    assert jaccard_classes(documents([])).collect() == []
    assert jaccard_classes(documents([(1, None), (2, "")])).where("linked").collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_region_links_connect_what_is_linked(seed):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 60, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[draw.random(60) < draw.choice([0.7, 0.95])], draw.integers(0, 99, draw.integers(0, 9), dtype=np.uint64)])) for _ in range(40)]
    found = region_links(sets, Limit(), pivot=0)
    label = list(range(40))
    for i, j in found:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)
        label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    assert label == classes([frozenset(s.tolist()) for s in sets])


def test_filters_pass_what_can_link():
    """The bounds that the filters rely on, for all sizes and overlaps up to 60."""
    limit = Limit()
    for a in range(1, 61):
        for b in range(1, a + 1):
            for both in range(b + 1):
                if 100 * both >= 75 * (a + b - both):
                    assert a - both <= limit.spare(np.array(a)) and b - both <= limit.spare(np.array(b))
                    assert b >= limit.least(np.array(a)) and both >= limit.least(np.array(a))
        assert 1 <= limit.first(np.array(a)) <= a
        assert limit.first(np.array(a)) - limit.spare(np.array(a)) >= min(limit.common(np.array(a)), a - limit.spare(np.array(a)))


@pytest.mark.parametrize("links", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)], [(7, 3), (3, 7), (9, 3), (100, 101)],
                                   [(random.Random(5).randint(0, 80), j) for j in range(60)], [(random.Random(j).randint(0, 99), j) for j in range(100)]])
def test_components(spark, links):
    label = {x: x for link in links for x in link if link[0] != link[1]}
    for a, b in links:
        if a != b:
            old, new = sorted((label[a], label[b]), reverse=True)
            label = {k: new if v == old else v for k, v in label.items()}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == label


def test_words_that_simple_hashes_confuse(documents):
    """A word of Thue and Morse and its complement are different n-grams."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join(pair[b] for b in bits) for pair in ("ab", "ba"))
    rows = jaccard_classes(documents([(1, one), (2, other), (3, f"a b c d {one}"), (4, f"a b c d {other}"), (5, one)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
