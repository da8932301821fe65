import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sealframe.llm.mixing import mix, rates, steps_around, thresholds

WEIGHTS = {"a": 0.5, "b": 0.1}


def uniform(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 16 ** 13


def plain(rows, weights, seed):
    """Copies per row from the distribution's own sums."""
    size = Counter()
    for _, text, _, source in rows:
        size[source if source in weights else None] += len(text or "") + 1
    share = {**weights, None: 1 - sum(weights.values())}
    out = Counter()
    for doc_id, text, _, source in rows:
        group = source if source in weights else None
        rate = share[group] * sum(size.values()) / size[group]
        u = uniform(f"{seed}:{doc_id}" if doc_id is not None else f"{seed}:t{hashlib.md5((text or '').encode()).hexdigest()}")
        k, p = 0, math.exp(-rate)
        while p <= u:
            k += 1
            p += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        out[doc_id, text] += k
    return {k: v for k, v in out.items() if v}


def rows():
    return [(i, f"text {i} " * (i % 7), "en", "a" if i % 10 == 0 else "b" if i % 10 < 5 else f"c{i % 3}") for i in range(600)] + \
        [(None, "n1", "en", None), (None, None, None, None), (None, "", "en", "a"), (5, "again", "en", "b"), (5, "again", "en", "b")]


def test_counts_are_the_inverted_distribution(documents):
    out = mix(documents(rows()), WEIGHTS, 3).collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == plain(rows(), WEIGHTS, 3)
    assert all(r["copy"] >= 0 for r in out) and len({(r["doc_id"], r["text"], r["copy"]) for r in out}) <= len(out)


def test_same_in_any_partitioning_and_other_seeds_differ(documents):
    docs = documents(rows())
    one, two = (sorted((str(r["doc_id"]), r["copy"], r["place"]) for r in mix(d, WEIGHTS, 3).collect()) for d in (docs, docs.coalesce(1)))
    assert one == two != sorted((str(r["doc_id"]), r["copy"], r["place"]) for r in mix(docs, WEIGHTS, 4).collect())


def test_shares(documents):
    out = mix(documents([(i, "x" * 99, "en", "a" if i < 300 else "z") for i in range(3000)]), {"a": 0.5}, 1)
    share = out.agg(F.avg((F.col("source") == "a").cast("int"))).first()[0]
    assert abs(share - 0.5) < 0.03


def test_places_are_sorted_inside_partitions(documents):
    parts = mix(documents(rows()), WEIGHTS, 3).select(F.spark_partition_id().alias("p"), "place").collect()
    assert [r["place"] for r in parts] == [x for p in sorted({r["p"] for r in parts}) for x in sorted(r["place"] for r in parts if r["p"] == p)]


def test_edges(documents):
    assert mix(documents([]), WEIGHTS, 1).count() == 0
    docs = documents(rows()).withColumn("copy", F.lit("clash")).withColumn("extra", F.lit(1))
    assert mix(docs, WEIGHTS, 1).schema["copy"].dataType.simpleString() == "int"
    assert mix(docs, {}, 1).count() > 0
    with pytest.raises(ValueError):
        mix(docs, {"a": 1.5}, 1)
    with pytest.raises(ValueError):
        rates(docs, {"b": 0.9}, F.lit(1.0), total=1e9)


def test_thresholds_reach_one():
    for rate in (0.0, 1e-9, 0.3, 5.0, 80.0, 500.0):
        found = thresholds(rate)
        assert found == sorted(found) and found[-1] >= 1 - 1e-9


def test_a_tiny_source_is_repeated_often(documents):
    tiny = [(1, "", "en", "a"), (2, "é", "en", "a"), (3, "x" * 30_000, "en", "z"), (4, None, "en", None)]
    out = mix(documents(tiny), {"a": 0.5}, 3)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == plain(tiny, {"a": 0.5}, 3)
    copies = sorted(r["copy"] for r in out.where("doc_id = 2").collect())
    assert copies == list(range(len(copies))) and 4500 < len(copies) < 5500
    assert out.columns == mix(documents(rows()), WEIGHTS, 3).columns


def test_sums_around_the_mean():
    first, found = steps_around(501.0)
    assert np.allclose(found[:200], (thresholds(501.0) + [1.0] * 400)[first:first + 200], atol=1e-12)
    for rate in (501.0, 30_000.5, 1e7):
        first, found = steps_around(rate)
        assert found == sorted(found) and found[0] < 1e-16 and found[-1] == 1.0
        assert abs(first + sum(p <= 0.5 for p in found) - rate) < 2
