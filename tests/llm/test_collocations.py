import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sealframe.llm import collocations as module
from sealframe.llm.collocations import Rules, best_cut, climb, collocations, words_of

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, rules):
    """Every phrase counted, every longer one looked through."""
    out = []
    for lang in {r[0] or "und" for r in rows}:
        f, n = Counter(), 0
        for text in [t for l, t in rows if (l or "und") == lang]:
            for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
                words = re.findall(r"[^ \t]+", piece)
                n += len(words)
                f.update(tuple(words[i:i + k]) for k in range(1, rules.longest + 1) for i in range(len(words) - k + 1))
        often = [g for g, c in f.items() if c >= rules.least and len(g) > 1]
        found = []
        for g in often:
            if any(len(h) > len(g) and 100 * f[h] >= rules.covered * f[g] and any(h[i:i + len(g)] == g for i in range(len(h))) for h in often):
                continue
            score, k = min((1000 * f[g] * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:rules.best])]
    return sorted(out)


def made(seed, texts=150, size=60):
    draw = np.random.default_rng(seed)
    words = ["the", "The", "of", "a", "ünï", "b\xa0c", "x" * 300, *"defghij"]
    weights = 1 / np.arange(1, len(words) + 1)
    marks = [" ", " ", " ", " ", "  ", "\t", " . ", "\n", ", ", "\x0b", " - "]
    rows = [(["en", "fr", None, "und", "en"][i % 5], "".join(words[draw.choice(len(words), p=weights / weights.sum())] + marks[draw.integers(len(marks))] for _ in range(draw.integers(0, size))))
            for i in range(texts)]
    passage = "one very common passage of many words, that stands everywhere"
    return rows + [("en", passage)] * 40 + [("fr", passage.upper())] * 7 + [(None, None), ("de", ""), ("de", " . \t!"), ("es", "alone " * 30)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, text string, phrase string, n int").repartition(5)


@pytest.mark.parametrize("rules,flush,bucket,parts", [
    (Rules(least=5), 16 << 20, 32 << 20, 8),
    (Rules(least=3, longest=3, best=20), 500, 64, 30),
    (Rules(least=2, longest=2), 2000, 1 << 20, 3),
    (Rules(least=4, covered=60, longest=4), 3000, 1000, 61),
    (Rules(least=300), 16 << 20, 32 << 20, 2),
])
def test_against_plain_counting(spark, monkeypatch, rules, flush, bucket, parts):
    """Small batches, many buckets, and ranges that begin within the phrases of a common word."""
    monkeypatch.setattr(module, "FLUSH", flush)
    monkeypatch.setattr(module, "BUCKET", bucket)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = made(rules.least)
        got = sorted(tuple(r) for r in collocations(frame(spark, rows), rules).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain(rows, rules) and (got or rules.least == 300)


def test_no_documents(spark):
    assert collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")).collect() == []


def test_words_of():
    texts = ["Ab  c\td. E,f", "", "g h i j k l m n", "ä\xa0ö ä"]
    words, ids, room = words_of([t.encode() for t in texts], 5)
    assert [words[int(i)].as_py() for i in ids] == ["ab", "c", "d", "e", "f", *"ghijklmn", "ä\xa0ö", "ä"]
    assert room.tolist() == [3, 2, 1, 1, 1, 5, 5, 5, 5, 4, 3, 2, 1, 2, 1]
    assert not len(words_of([b""], 5)[1]) and not len(words_of([b" .\t", b"\n"], 5)[1])


def test_climb_over_any_ranges():
    """Wherever the sorted counts are cut, the parts and what they miss give the same as the whole."""
    counts = {"": 99, "a": 50, "a b": 20, "a b c": 7, "a b d": 9, "a c": 8, "b": 30, "b b": 11, "c": 5}
    rows = sorted(("en", k.split(), f) for k, f in counts.items()) + [("fr", [], 3), ("fr", ["a"], 3)]
    whole = {(l, " ".join(w)): (f, above, most) for l, w, f, above, most in climb(iter(rows))}
    assert whole["en", "a b d"] == (9, [99, 50, 20], 0) and whole["en", "a b"][2] == 9 and whole["en", "a"][2] == 20
    for cut in range(len(rows) + 1):
        parts = [*climb(iter(rows[:cut])), *climb(iter(rows[cut:]))]
        missing = {(l, " ".join(w)): most for l, w, f, _, most in parts if f is None}
        assert len(missing) <= 3
        for l, w, f, above, most in parts:
            if f is not None:
                full = [whole[l, " ".join(w[:i])][0] if x is None else x for i, x in enumerate(above)]
                assert (f, full, max(most, missing.get((l, " ".join(w)), 0))) == whole[l, " ".join(w)]


def test_scores_pass_64_bits():
    a, n = 10 ** 12 + 1, 10 ** 13 + 7
    assert best_cut(a, n, [a, 10 ** 13], [10 ** 12 + 3, a]) == (1000 * a * n // (10 ** 13 * a), 10 ** 13, a)
    assert best_cut(4, 100, [10, 10], [10, 10]) == (4000, 10, 10)


def test_equal_hashes(spark, monkeypatch):
    """Phrases are told apart by their words, whatever they hash to."""
    monkeypatch.setattr(module, "mix", lambda h: (h % np.uint64(4)) << np.uint64(60))
    rows = made(1, texts=40)
    docs = frame(spark, rows)
    with module.staging_folder(spark) as folder:
        batches = list(module._batches(docs, Rules()).where("phrases IS NULL").toArrow().to_batches())
    batch = next(module._read(iter(batches)))
    assert len(np.unique(batch.hashes((1, 2))[1][0])) <= 4
    at = batch.places(2)
    counts = batch.counts(2, at, batch.hashes((2,))[1][0], 7)
    direct = Counter((batch.ids[i], batch.ids[i + 1]) for i in at)
    assert sorted(sum(counts.column("counts").to_pylist(), [])) == sorted(direct.values())
    assert len(set(sum(counts.column("phrases").to_pylist(), []))) == len(direct) and counts.num_rows <= 4
    narrowed = batch.narrowed(2, at[::3])
    assert isinstance(narrowed.dictionary, pa.Array) and narrowed.live.sum() == len(at[::3])
