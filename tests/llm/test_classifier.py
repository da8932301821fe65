import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sealframe.llm.classifier import FEATURES, Fit, Trees, fit, measured, scored, statistics, trained

TEXTS = [None, "", " \n", "a", "One two  two.\nOne two  two.\n\nÉ 12% | x!", "z " * 40_000, "A,b;c: #d", "\x0b\x0c\r"]


def test_statistics():
    got = statistics(pa.array(TEXTS, pa.string()))
    for text, row in zip(TEXTS, got):
        row, raw = dict(zip(FEATURES, row)), (text or "").encode()
        words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
        assert row["bytes"] == len(raw) and row["words"] == len(words)
        assert np.isclose(row["upper"], len(re.findall(rb"[A-Z]", raw)) / max(1, len(raw)))
        assert np.isclose(row["non_ascii"], len(re.findall(rb"[\x80-\xff]", raw)) / max(1, len(raw)))
        assert np.isclose(row["distinct_words"], len(set(words)) / max(1, len(words)))
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        assert np.isclose(row["distinct_windows"], len(set(windows)) / max(1, len(windows)))
        assert row["longest_word"] == max(map(len, words), default=0)
        assert np.isfinite(list(row.values())).all()


def test_flat_trees_walk_as_a_plain_one():
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(600, 5))
    trees = fit(rows, (rows[:, 1] * rows[:, 3] > 0).astype(float), Fit(trees=20, depth=3))

    def walk(row):
        total = trees.base
        for features, cuts, values in zip(trees.features, trees.cuts, trees.values):
            at = 0
            while at < len(features):
                at = 2 * at + 1 + int(row[features[at]] > cuts[at])
            total += values[at - len(features)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.score(rows), [walk(r) for r in rows])
    assert ((trees.score(rows) > 0.5) == (rows[:, 1] * rows[:, 3] > 0)).mean() > 0.95


def test_without_both_labels():
    assert np.allclose(fit(np.zeros((5, 3)), np.ones(5)).score(np.zeros((2, 3))), 0.999)
    assert np.allclose(fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))), 0.5)
    assert isinstance(fit(np.zeros((9, 3)), np.arange(9) % 2.0), Trees)


def test_held_out_accuracy(documents, spark):
    draw = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        words = [f"word{draw.randint(0, 500)}" for _ in range(draw.randint(30, 200))]
        rows.append((i, " ".join(w + "%%%" if bad and draw.random() < 0.5 else w for w in words)))
        labels.append((i, int(not bad), 0))
    rows += [(2000, None), (None, "x"), (2001, ""), (5, "twice")]
    labels += [(None, 1, 0), (3, None, 0)]
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    stats = measured(documents(rows).withColumn("stats", F.lit("clash")))
    out = scored(stats, trained(stats, frame, Fit(sample=400))).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] != 5 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert {r["doc_id"] for r in held} <= {r["doc_id"] for r in out if r["held_out"]}
    assert np.mean([r["predicted"] == int(r["doc_id"] % 6 != 0) for r in held]) > 0.97


def test_held_out_labels_are_not_learned(documents, spark):
    rows = [(i, f"text {i}") for i in range(200)]
    out = []
    for flip in (0, 1):
        labels = [(i, (i % 2) ^ (flip if zlib.crc32(str(i).encode()) % 5 == 0 else 0), 0) for i in range(200)]
        stats = measured(documents(rows))
        out.append(trained(stats, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")))
    assert (out[0].values == out[1].values).all() and (out[0].cuts == out[1].cuts).all()


def test_no_documents(documents, spark):
    stats = measured(documents([]))
    assert scored(stats, trained(stats, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))).collect() == []


def plain_statistics(text):
    """Character by character and word by word."""
    raw = (text or "").encode()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    lines = raw.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    ended = [x + b"\n" for x in lines[:-1]] + [lines[-1] + (b"\n" if raw.endswith(b"\n") else b"")] if lines else []
    share = lambda test: sum(map(test, raw)) / max(1, len(raw))
    visible = lambda c: 0x21 <= c < 0x7F
    return {
        "bytes": len(raw), "words": len(words), "lines": len(lines), "bytes_per_word": sum(map(len, words)) / max(1, len(words)), "words_per_line": len(words) / max(1, len(lines)),
        "upper": share(lambda c: chr(c) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": share(lambda c: chr(c) in "0123456789"),
        "ascii_letters": share(lambda c: visible(c) and chr(c).isalpha()), "non_ascii": share(lambda c: c >= 0x80), "marks": share(lambda c: visible(c) and not chr(c).isalnum()),
        "symbols": share(lambda c: chr(c) in "#*$%&<>@^~={}[]\\_+"), "exclamations": share(lambda c: chr(c) in "!?"), "bars": share(lambda c: chr(c) == "|"),
        "periods": share(lambda c: chr(c) == "."), "commas": share(lambda c: chr(c) in ",;:"), "spaces": share(lambda c: chr(c) in " \t"),
        "distinct_words": len(set(words)) / max(1, len(words)), "distinct_windows": len(set(windows)) / max(1, len(windows)),
        "distinct_lines": len(set(ended)) / max(1, len(lines)), "longest_word": max(map(len, words), default=0),
    }


def plain_boosting(rows, labels, how):
    """Every feature and cut is tried at every node, on lists of rows; returns a function of a row."""
    share = min(max(sum(labels) / len(labels), 1e-3), 1 - 1e-3)
    base, trees = np.log(share / (1 - share)), []
    cuts = [sorted(set(np.quantile([r[f] for r in rows], np.linspace(0, 1, how.bins + 1)[1:-1]).tolist())) for f in range(len(rows[0]))]

    def walk(tree, row):
        while isinstance(tree, tuple):
            f, cut, low, high = tree
            tree = high if f is not None and row[f] > cut else low
        return tree

    def raw(row):
        return base + sum(walk(t, row) for t in trees)

    for _ in range(how.trees):
        p = [1 / (1 + np.exp(-raw(r))) for r in rows]
        grad, hess = [a - b for a, b in zip(p, labels)], [a * (1 - a) for a in p]

        def grow(members, depth):
            g, h = sum(grad[i] for i in members), sum(hess[i] for i in members)
            if depth == 0:
                return -how.rate * g / (h + how.penalty)
            best = (0, None, None)
            for f, options in enumerate(cuts):
                found = (0, None)
                for cut in options:
                    low = [i for i in members if rows[i][f] <= cut]
                    gl, hl = sum(grad[i] for i in low), sum(hess[i] for i in low)
                    if hl >= how.least and h - hl >= how.least:
                        gain = gl ** 2 / (hl + how.penalty) + (g - gl) ** 2 / (h - hl + how.penalty) - g ** 2 / (h + how.penalty)
                        if gain > found[0] + 1e-12:
                            found = (gain, cut)
                if found[0] > best[0] + 1e-12:
                    best = (found[0], f, found[1])
            _, f, cut = best
            low = [i for i in members if f is None or rows[i][f] <= cut]
            high = [i for i in members if f is not None and rows[i][f] > cut]
            return f, cut, grow(low, depth - 1), grow(high, depth - 1)

        trees.append(grow(range(len(rows)), how.depth))
    return lambda row: 1 / (1 + np.exp(-raw(row)))


def test_whole_query_against_plain_boosting(documents, spark):
    """From texts and labels to scores, with statistics, trees and folds made once more in plain Python."""
    draw, how = random.Random(9), Fit(trees=5, depth=3, bins=8)
    texts = [*TEXTS[:5], *TEXTS[6:]] + ["".join(draw.choice(["Word ", "ab ", "x, ", "9 ", "é! ", "# ", "same line\nsame line\n", "| "]) for _ in range(draw.randint(0, 60))) for _ in range(140)]
    rows = [(i, t) for i, t in enumerate(texts)]
    labels = [(i, int(len(t or "") % 3 > 0 and "#" not in (t or "")[:20]), 0) for i, t in rows if i % 9]
    stats = measured(documents(rows))
    for r in stats.collect():
        plain = plain_statistics(texts[r["doc_id"]])
        assert np.allclose(r["stats"], [plain[f] for f in FEATURES]), texts[r["doc_id"]]
    got = scored(stats, trained(stats, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), how)).collect()
    learned = [(i, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 5]
    features = {i: [plain_statistics(t)[f] for f in FEATURES] for i, t in rows}
    score = plain_boosting([features[i] for i, _ in learned], [float(y) for _, y in learned], how)
    assert len(got) == len(rows)
    for r in got:
        want = score(features[r["doc_id"]])
        assert abs(r["score"] - want) < 1e-6 and r["predicted"] == int(want >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
