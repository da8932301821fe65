"""Token ids against the library's own over whole texts; the codec's round trips."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sealframe.llm import rans
from sealframe.llm.id_files import read_ids, write_ids
from sealframe.llm.tokens import Encoder, document_ids
from sealframe.session import shared_folder

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", "  a  b", "a\n b c\t d", "don't 're x 's it's'll", "Σας ΣΑΣ Σ", "é ́x", "a b 　c", "10 000 3.5 %%%", "\x1c a\x1d b", "ǅ é È", "a  b   c ", "foo .\n\nBar",
       None, " x", "a ", " ", "日本 語 a", "ſ É ż b", "a≠b c≮", "x" * 5000 + " y", "A!B!!C 'S", "퟿ \U0001f600 z"]


@pytest.mark.parametrize("file", FILES)
def test_odd_texts(file):
    path = public_tokenizers.path(file)
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t or "", add_special_tokens=False).ids + [2] for t in ODD]
    assert [x.tolist() for x in document_ids(pa.array(ODD), path, 2)] == want


ADDED = ["one <|endoftext|> two", "<|endoftext|>", "a<|startoftext|>b c", "<|endoftext|><|endoftext|> x", "cut <|endof", "text|> here", "<|endoftext|", "one two",
         "x <|ENDOFTEXT|> y", "漢 <|endoftext|>é  b", "<|startoftext|> a!b <|endoftext|>\n c"]


@pytest.mark.parametrize("file", FILES)
def test_texts_with_added_tokens(file):
    path = public_tokenizers.path(file)
    plain = Tokenizer.from_file(path)
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in ADDED]
    assert [x.tolist() for x in document_ids(pa.array(ADDED), path, 2)] == want
    assert any(plain.token_to_id("<|endoftext|>") in x for x in want)


@pytest.fixture(scope="module")
def encoders():
    paths = [public_tokenizers.path(f) for f in FILES]
    return [(Encoder(p), Tokenizer.from_file(p)) for p in paths]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé ß\n\t'st.,!1۳Σ́-≮ſż漢_  "), max_size=40), min_size=1, max_size=6))
def test_any_texts(encoders, texts):
    for own, plain in encoders:
        ids, offsets = own.ids(pa.array(texts, pa.string()), 7)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [plain.encode(t, add_special_tokens=False).ids + [7] for t in texts]


def test_memory_is_bounded(monkeypatch):
    from sealframe.llm import tokens

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    own = Encoder(public_tokenizers.path(FILES[0]))
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    for i in range(20):
        texts = [f"word{i} word{j} thing{i * j}" for j in range(10)]
        ids, offsets = own.ids(pa.array(texts), 2)
        assert [ids[a:b].tolist()[:-1] for a, b in zip(offsets, offsets[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.hashes) <= 50


def test_long_parts_are_not_remembered():
    own = Encoder(public_tokenizers.path(FILES[0]))
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    for i in range(6):
        texts = [f"漢字{i}" * 400 + f" short{i} word", f"word x{i}"]
        ids, offsets = own.ids(pa.array(texts), 2)
        assert [ids[a:b].tolist()[:-1] for a, b in zip(offsets, offsets[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert own.used < 100


@pytest.mark.parametrize("n,kinds", [(0, 1), (1, 1), (5, 3), (1023, 7), (1024, 7), (1025, 40_000), (300_000, 50_000), (600_000, 1)])
def test_codec_round_trip_from_every_checkpoint(n, kinds):
    ids = (np.random.default_rng(n).zipf(1.2, n) % kinds).astype("<u4")
    table = rans.Table.unpack(rans.Table.of(ids).pack())
    if n:
        assert table.frequencies.sum() == 1 << table.bits and table.frequencies.min() > 0
    block = rans.encode(ids, table)
    assert block.crc == zlib.crc32(ids.tobytes())
    for since in range(max(1, len(block.places))):
        assert (rans.decode(block, table, since) == ids[since * rans.CHECKPOINT:]).all()


def test_large_symbols():
    ids = np.random.default_rng(2).integers(0, 1 << 32, 3000, dtype=np.uint64).astype("<u4")
    table = rans.Table.unpack(rans.Table.of(ids).pack())
    assert (rans.decode(rans.encode(ids, table), table) == ids).all()


def test_coded_size_is_near_the_entropy():
    ids = np.random.default_rng(1).geometric(0.05, 900_000).astype("<u4")
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    block = rans.encode(ids, rans.Table.of(ids))
    assert len(block.words) * 32 < 1.01 * len(ids) * -(p * np.log2(p)).sum() + 64


def test_a_changed_word_is_found():
    ids = np.arange(50_000, dtype="<u4") % 77
    table = rans.Table.of(ids)
    block = rans.encode(ids, table)
    block.words = block.words.copy()
    block.words[3] ^= 1
    with pytest.raises(ValueError):
        rans.decode(block, table)


def test_files(documents, spark):
    rows = [(9, "b c"), (3, None), (None, "n"), (3, "again"), (3, "again"), (12, "long text " * 30_000), (1, ""), (40, "é")]
    path = f"{shared_folder(spark)}/ids"
    tokenizer = public_tokenizers.path(FILES[0])
    write_ids(documents(rows), path, tokenizer, 2)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_ids(spark, path).collect()), key=lambda r: r[1])
    plain = Tokenizer.from_file(tokenizer)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4"))
    assert [r[0] for r in got] == [None, 1, 3, 3, 3, 9, 12, 40]
    at = 0
    for doc_id, start, n, crc in got:
        assert start == at and (n, crc) in [(len(x), zlib.crc32(x.tobytes())) for x in texts[doc_id]]
        at += n


def test_no_documents(documents, spark):
    path = f"{shared_folder(spark)}/ids"
    write_ids(documents([]), path, public_tokenizers.path(FILES[0]), 2)
    assert read_ids(spark, path).collect() == []


def thue_morse(n):
    """The word of n letters and its complement, which polynomials modulo powers of two do not tell apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1 << k for k in range(4, 17)])
def test_texts_that_simple_hashes_confuse(n):
    from sealframe.llm.bytehash import span_hashes

    one, other = thue_morse(n)
    raw = np.frombuffer((one + other).encode(), np.uint8)
    hashes = span_hashes(raw, np.array([0, n]), np.array([n, 2 * n]))
    assert hashes[0] != hashes[1]


@pytest.mark.parametrize("file", FILES)
def test_parts_are_told_apart_by_their_bytes(file, monkeypatch):
    """Whatever the hashes: all the same, or those of the odd words."""
    from sealframe.llm import tokens

    path = public_tokenizers.path(file)
    plain = Tokenizer.from_file(path)
    texts = [*thue_morse(4096), *ODD, *thue_morse(2048)]
    want = [plain.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for hashed in (tokens.span_hashes, lambda buffer, start, end: np.zeros(len(start), np.uint64)):
        monkeypatch.setattr(tokens, "span_hashes", hashed)
        own = Encoder(path)
        for _ in range(3):  # the second time from memory
            ids, offsets = own.ids(pa.array(texts, pa.string()), 2)
            assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_hashes_do_not_depend_on_the_place():
    from sealframe.llm.bytehash import span_hashes

    text = b"x" * 3 + b"same words" + b"y" * 100_000 + b"same words"
    raw, at = np.frombuffer(text, np.uint8), np.array([3, len(text) - 10])
    hashes = span_hashes(raw, at, at + 10)
    assert hashes[0] == hashes[1] == span_hashes(np.frombuffer(b"same words", np.uint8), np.array([0]), np.array([10]))[0]
    one = span_hashes(np.frombuffer(b"ab", np.uint8), np.array([0, 1, 0, 0]), np.array([1, 2, 2, 0]))
    assert len(set(one.tolist())) == 4


def test_a_row_group_for_each_frame(documents, spark, monkeypatch):
    """Readers can take frames one by one, and writers need not hold more than one."""
    from pathlib import Path

    import pyarrow.parquet as pq

    from sealframe.llm import id_files

    monkeypatch.setattr(id_files, "FRAME", 100)
    path = f"{shared_folder(spark)}/ids"
    write_ids(documents([(i, "some words " * 60) for i in range(40)]).coalesce(1), path, public_tokenizers.path(FILES[0]), 2)
    found = [pq.ParquetFile(f).metadata for f in Path(path.removeprefix("file:").replace("//", "/")).glob("*.parquet")]
    assert sum(m.num_row_groups for m in found) == sum(m.num_rows for m in found) == 40
    assert sorted(r["doc_id"] for r in read_ids(spark, path).collect()) == list(range(40))
