import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sealframe.llm.packing import Packer, Steps, Tiers, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_packer_places_every_id_once(seed):
    draw, tiers = random.Random(seed), Tiers(longest=64, shortest=8, pool=500)
    packer, lengths = Packer(tiers), [draw.choice([1, 3, 7, 20, 33, 64, 65, 200, draw.randint(1, 300)]) for _ in range(300)]
    for doc, n in enumerate(lengths):
        packer.add(doc, n)
        if doc % 40 == 0:
            packer.pack()
    packer.finish()
    seen, padded = defaultdict(list), 0
    for context, window in packer.done:
        total = sum(p.length for p in window)
        assert total <= context and context in tiers.sizes() and all(p.length > 0 for p in window)
        padded += total < context
        for p in window:
            seen[p.doc].append((p.start, p.length))
    assert padded <= 1
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at
            at += length
        assert at == n


def test_short_documents_stay_whole_where_they_fit():
    packer = Packer(Tiers(longest=64, shortest=8))
    for doc in range(8):
        packer.add(doc, 40)
    for doc in range(8, 40):
        packer.add(doc, 8)
    packer.pack()
    whole = [p.length for _, w in packer.done for p in w]
    assert whole.count(40) == 8 and set(whole) == {40, 8}


def test_steps_have_one_context_and_as_many_ids():
    steps, tiers = defaultdict(list), Tiers(longest=64, shortest=8, step=256)
    deal = Steps(tiers)
    for context in random.Random(2).choices([64, 32, 16, 8], k=2000):
        steps[deal.of(context)].append(context)
    full = [s for s in steps.values() if sum(s) == 256]
    assert all(len(set(s)) == 1 and sum(s) <= 256 for s in steps.values()) and len(full) >= len(steps) - 4


def test_documents(documents):
    rows = [(1, "one two"), (2, None), (3, ""), (None, "none"), (4, "long words here " * 9000), (5, "same"), (5, "same"), *[(100 + i, f"text {i} " * (i % 90)) for i in range(400)]]
    out = pack_documents(documents(rows).withColumn("length", F.lit("clash")), PATH, 2).collect()
    plain = Tokenizer.from_file(PATH)
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        ids = texts[r["doc_id"]][0]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["context"], r["step_id"]))
    for doc_id, found in pieces.items():
        assert sum(n for _, n in found) == len(texts[doc_id][0]) * len(texts[doc_id])
    assert pieces.keys() == texts.keys()
    short = 0
    for parts in sequences.values():
        at = 0
        for offset, n, _, _ in sorted(parts):
            assert offset == at
            at += n
        assert len({p[2:] for p in parts}) == 1 and at <= parts[0][2] <= 4096
        short += at < parts[0][2]
    assert short <= 3  # one a task at most


def test_no_documents(documents):
    assert pack_documents(documents([]), PATH, 2).collect() == []


def test_nothing_is_padded_and_steps_go_over_tasks(documents):
    """Every sequence is full; all steps of a context but its last have as many sequences, whichever tasks they come from."""
    draw = random.Random(4)
    rows = [(i, " ".join(f"w{draw.randint(0, 99)}" for _ in range(draw.choice([0, 5, 60, 300, 2500])))) for i in range(250)]
    tiers = Tiers(longest=1024, shortest=128, step=4096, tail=1)
    out = pack_documents(documents(rows).repartition(7), PATH, 2, tiers).collect()
    lengths, contexts, steps = defaultdict(int), {}, defaultdict(set)
    for r in out:
        lengths[r["sequence_id"]] += r["length"]
        contexts[r["sequence_id"]] = r["context"]
        steps[r["step_id"]].add((r["sequence_id"], r["context"]))
    assert all(lengths[s] == contexts[s] for s in lengths)
    assert sum(c < 128 for c in contexts.values()) <= 7 * 7
    for context in set(contexts.values()):
        sizes = sorted(len(s) for s in steps.values() if {c for _, c in s} == {context})
        assert sizes and all(n == 4096 // context for n in sizes[1:]) and sum(sizes) == sum(c == context for c in contexts.values())
    assert all(len({c for _, c in s}) == 1 for s in steps.values())


@pytest.mark.parametrize("n", [1, 7, 255, 300, 4097])
def test_tails_are_powers_of_two(n):
    packer = Packer(Tiers(tail=1))
    packer.add(0, n)
    packer.finish()
    assert all(sum(p.length for p in w) == context for context, w in packer.done) and sum(c for c, _ in packer.done) == n
