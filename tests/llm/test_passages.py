"""Planted passages are found and removed, exact and edited ones; other texts are left alone."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sealframe.llm import passages
from sealframe.llm.passages import Fenwick, Passage, align, chains, repeated_passages, seeds, without_passages


def words(draw, n):
    return [f"w{draw.randint(0, 10 ** 6)}" for _ in range(n)]


def spans(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["from_doc"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("flush", [1_000_000, 40])
def test_planted(documents, monkeypatch, flush):
    monkeypatch.setattr(passages, "FLUSH", flush)
    draw = random.Random(1)
    passage, other = words(draw, 70), words(draw, 55)
    edited = list(passage)
    edited[20], edited[45] = "changed", "too"
    shifted = passage[:30] + ["three", "new", "words"] + passage[30:]
    rows = {
        3: words(draw, 30) + passage + words(draw, 40),
        10: words(draw, 12) + passage + words(draw, 9),
        11: passage + words(draw, 5),
        12: words(draw, 80) + edited,
        13: words(draw, 20) + shifted + words(draw, 20),
        14: words(draw, 25) + passage[:45],  # too short
        20: words(draw, 100),
        21: words(draw, 10) + other + words(draw, 10) + passage + words(draw, 3),
        22: other + words(draw, 60),
        30: [w.upper() for w in passage],
        31: words(draw, 200), 32: None,
    }
    rows[32] = list(rows[31])
    docs = documents([(i, None if w is None else "\n ".join(w)) for i, w in rows.items()] + [(50, None), (51, ""), (52, "few words")])
    got = spans(repeated_passages(docs))
    assert got == {10: [(12, 82, 3)], 11: [(0, 70, 3)], 12: [(80, 150, 3)], 13: [(20, 93, 3)], 21: [(75, 145, 3)], 22: [(0, 55, 21)],
                   30: [(0, 70, 3)], 32: [(0, 200, 31)]}
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in without_passages(docs, repeated_passages(docs)).collect()}
    want = {i: w and [x for k, x in enumerate(w) if not any(a <= k < b for a, b, _ in got.get(i, []))] for i, w in rows.items()}
    assert {i: t and t[0] and t[0].split() for i, t in left.items() if i < 50} == {i: w for i, w in want.items() if w is None or w}
    assert all(n == (None if t is None else len(t)) for t, n in left.values()) and {50, 51, 52} <= left.keys()
    assert left[3][0] == "\n ".join(rows[3])


def test_clean_documents_are_left_alone(documents):
    """Texts of few different words share many short runs, but no passage."""
    draw = random.Random(4)
    rows = [(i, " ".join(f"v{draw.randint(0, 60)}" for _ in range(300))) for i in range(60)]
    assert repeated_passages(documents(rows)).collect() == []


def test_a_hot_passage(documents):
    draw = random.Random(6)
    passage = words(draw, 60)
    rows = [(i, " ".join([*words(draw, 5), *passage, *words(draw, 5)])) for i in range(400)]
    got = spans(repeated_passages(documents(rows)))
    assert got == {i: [(5, 65, 0)] for i in range(1, 400)}


def test_a_text_that_repeats_itself(documents):
    draw = random.Random(7)
    part = words(draw, 25)
    rows = [(1, " ".join(part * 8)), (2, " ".join([*words(draw, 30), *part * 6])), (3, " ".join(part * 3 + words(draw, 10)))]
    got = spans(repeated_passages(documents(rows)))
    assert got == {2: [(30, 180, 1)], 3: [(0, 75, 1)]}


def test_ids_that_are_null_or_repeated(documents):
    draw = random.Random(8)
    passage = " ".join(words(draw, 80))
    rows = [(None, passage), (None, passage + " x"), (4, passage + " y"), (4, passage + " z"), (4, passage + " z"), (5, "q " + passage)]
    docs = documents(rows).withColumn("tie", F.lit("clash"))
    found = repeated_passages(docs)
    assert any(r["doc_id"] == 5 for r in found.collect())
    assert without_passages(docs, found).columns == docs.columns


def test_no_documents(documents):
    docs = documents([])
    assert repeated_passages(docs).collect() == []
    assert without_passages(docs, repeated_passages(docs)).collect() == []


def test_any_shared_run_has_a_seed():
    how, draw = Passage(), random.Random(9)
    for _ in range(50):
        run = words(draw, how.seed + how.window - 1)
        texts = [" ".join(words(draw, draw.randint(0, 30)) + run + words(draw, draw.randint(0, 30))) for _ in range(2)]
        key, text, _, _ = seeds(pa.array(texts), how)
        assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())


def test_fenwick():
    draw, tree, values = random.Random(3), Fenwick(30), [-np.inf] * 30
    for i in range(200):
        at, score = draw.randrange(30), draw.random()
        tree.put(at, score, i)
        values[at] = max(values[at], score)
        to = draw.randrange(30)
        assert tree.get(to)[0] == max(values[:to + 1])


def test_chains_skip_noise_and_keep_order():
    how = Passage()
    x = np.array([0, 4, 9, 20, 26, 31, 12, 200, 206])
    p = np.array([100, 104, 109, 123, 129, 134, 7, 300, 306])  # an insertion of 3 words, a stray match, another passage
    assert sorted(chains(x, p, how)) == [(0, 37, 100, 140, False), (200, 212, 300, 312, True)]
    assert chains(np.array([5]), np.array([9]), how) == []


def plain_chains(runs, how):
    """Scores by trying all predecessors."""
    score = []
    for xa, xb, pa_, _ in runs:
        best = 0.0
        for j in range(len(score)):
            gaps = xa - runs[j][1], pa_ - runs[j][3]
            if min(gaps) >= 0 and max(gaps) <= how.gap:
                best = max(best, score[j] - how.gap_cost * sum(gaps))
        score.append(xb - xa + best)
    return score


def test_a_long_passage_does_not_hide_nearer_runs():
    how = Passage()
    long = np.arange(0, 200, 6)
    # Six runs of an edited passage, a word longer each time, 100 words after an exact one of 200.
    x = np.concatenate([long, 300 + 12 * np.arange(6)])
    p = np.concatenate([long, 300 + 13 * np.arange(6)])
    assert sorted(chains(x, p, how)) == [(0, 204, 0, 204, True), (300, 366, 300, 371, False)]


def test_nearest_runs_are_those_of_trying_all():
    how, draw = Passage(), random.Random(5)
    for _ in range(200):
        ends = sorted(draw.sample(range(150), 40))
        runs = sorted((e - draw.randint(1, 5), e, q - 3, q) for e, q in ((e, draw.randint(3, 150)) for e in ends))
        tree, score = passages.Nearest(how.gap), []
        done, at = sorted(range(len(runs)), key=lambda i: runs[i][1]), 0
        for i, (xa, xb, pa_, _) in enumerate(runs):
            while at < len(done) and runs[done[at]][1] <= xa:
                j = done[at]
                tree.put(runs[j][1], runs[j][3], score[j] + how.gap_cost * (runs[j][1] + runs[j][3]), j)
                at += 1
            value, j = tree.get(xa, [q for q in range(pa_ - how.gap, pa_ + 1)])
            value -= how.gap_cost * (xa + pa_)
            score.append(xb - xa + (value if j >= 0 and value > 0 else 0))
        assert np.allclose(score, plain_chains(runs, how))


def test_sparse_agreement_does_not_hide_a_passage(documents):
    draw = random.Random(11)
    rows, want = [], {}
    for i in range(30):
        passage, tails = words(draw, 60), [words(draw, 10) for _ in range(4)]
        rows += [(i, " ".join(sum([[*words(draw, 20), *t] for t in tails], passage)))]
        rows += [(100 + i, " ".join(sum([[*words(draw, 20), *t] for t in tails], words(draw, 15) + passage)))]
        want[100 + i] = range(15, 75)
    got = spans(repeated_passages(documents(rows)))
    assert got.keys() == want.keys()
    for i, covered in want.items():
        assert any(a <= covered[0] and b > covered[-1] for a, b, _ in got[i])


def test_stretches_of_a_span():
    how = Passage()
    marks = lambda *runs: np.concatenate([np.full(n, kind) for n, kind in runs])
    assert passages.stretches(marks((60, True), (200, False), (55, True), (40, False), (49, True)), how) == [(0, 60, 60), (260, 315, 55)]
    # Two pieces that are a passage only together; a piece that is too short; few equal words.
    assert passages.stretches(marks((100, False), (40, True), (12, False), (8, True), (90, False), (45, True)), how) == [(100, 160, 48)]
    assert passages.stretches(np.arange(400) % 2 == 0, how) == [] == passages.stretches(marks((45, True), (60, False)), how)


def test_alignment_stops_at_the_passage():
    a, b = np.arange(100), np.concatenate([np.arange(500, 520), np.arange(30, 80), np.arange(700, 720)])
    assert align(a, b, (40, 60, 30, 50), True, Passage()) == (30, 80, 50)
    assert align(a, b, (40, 60, 30, 50), False, Passage()) == (30, 80, 50)


def test_a_long_run_has_a_long_seed():
    how, draw = Passage(), random.Random(12)
    for _ in range(50):
        run = words(draw, how.long + how.window - 1)
        texts = [" ".join(words(draw, draw.randint(0, 30)) + run + words(draw, draw.randint(0, 30))) for _ in range(2)]
        key, text, word, _ = seeds(pa.array(texts), how)
        assert set(key[(text == 0) & (word < 0)].tolist()) & set(key[(text == 1) & (word < 0)].tolist())


@pytest.mark.parametrize("parts", [(40, 40), (30, 30, 30), (20, 42, 20), (25, 25)])
def test_passages_whose_parts_come_from_different_documents(documents, parts):
    """Earlier documents have a part each; two later ones have all of them, and the second is found to repeat the first."""
    draw, rows, want = random.Random(sum(parts)), [], {}
    for i in range(100):
        pieces = [words(draw, n) for n in parts]
        for j, piece in enumerate(pieces):
            rows.append((1000 * i + j, " ".join(words(draw, 15) + piece + words(draw, 15))))
        for j in (500, 501):
            rows.append((1000 * i + j, " ".join(words(draw, 9) + sum(pieces, []) + words(draw, 9))))
        want[1000 * i + 501] = [(9, 9 + sum(parts), 1000 * i + 500)]
    assert spans(repeated_passages(documents(rows))) == want


def exact_runs(texts, least):
    """By comparing every window of ``least`` words with those of all earlier texts: which words of each text are in one."""
    seen, covered = set(), {}
    for i, text in sorted(texts.items()):
        own = {j: tuple(text[j:j + least]) for j in range(len(text) - least + 1)}
        marks = {j + k for j, w in own.items() if w in seen for k in range(least)}
        if marks:
            covered[i] = marks
        seen |= set(own.values())
    return covered


def first_holders(texts, size):
    first = {}
    for i, text in sorted(texts.items()):
        for j in range(len(text) - size + 1):
            first.setdefault(tuple(text[j:j + size]), i)
    return first


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_runs_of_random_documents(documents, seed):
    """Texts glued from runs of each other, of any length. What is missed of the words that brute force finds in a repeated run of 50 is
    known: an earlier document has a long seed of the run, but not all of its 50 words."""
    draw, how = random.Random(seed), Passage()
    texts = {0: words(draw, 300)}
    for i in range(1, 150):
        made = []
        while len(made) < 250:
            source = texts[draw.randrange(i)]
            at, n = draw.randrange(len(source)), draw.choice([10, 20, 30, 38, 42, 50, 55, 80, 120])
            made += source[at:at + n] if draw.random() < 0.7 else words(draw, draw.randint(1, 30))
        texts[i] = made
    want, seeds_of, runs_of = exact_runs(texts, 50), first_holders(texts, how.long), first_holders(texts, 50)
    got = {i: {k for a, b, _ in found for k in range(a, b)} for i, found in spans(repeated_passages(documents([(i, " ".join(t)) for i, t in texts.items()]))).items()}
    missed = [(i, k) for i, marks in want.items() for k in marks - got.get(i, set())]
    assert len(missed) <= 0.015 * sum(map(len, want.values()))
    for i, k in missed:
        t = texts[i]
        runs = [j for j in range(max(0, k - 49), k + 1) if j + 50 <= len(t) and runs_of[tuple(t[j:j + 50])] < i]
        assert any(seeds_of[tuple(t[j + d:j + d + how.long])] < runs_of[tuple(t[j:j + 50])] for j in runs for d in range(50 - how.long + 1))
