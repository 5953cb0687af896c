"""Byte-level BPE along a trie against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.cases import documents, with_clashes
from tokenizers import Tokenizer

from tunetables.llm import byte_bpe
from tunetables.llm.queries import op13_byte_bpe, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "  ", "\n", "'s", "'re", "1", "22", "é", "日本", " ", "　", "\x1c", "\x85", "!!", "====",
          "<|endoftext|>", "<|endof", "\U0001f600", "é", "the", "ing", "\t", "​", "\x00", "ⅷ", "²"]


@cache
def tools():
    return Tokenizer.from_file(PATH), byte_bpe.TrieEncoder(PATH)


@pytest.fixture
def library():
    return tools()[0]


@pytest.fixture
def encoder():
    return tools()[1]


def ids(blob):
    return np.frombuffer(blob, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=30).map("".join), st.text("abcdeforstin ", max_size=60)))
def test_any_text(text):
    library, encoder = tools()
    want = library.encode(text, add_special_tokens=False).ids
    got = encoder.encode([text])[0]
    assert ids(got) == want
    assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_long_words(encoder, library):
    for text in ("abcde" * 20_000, "=" * 50_001, "z" * 30_000 + " " * 7_000, "né" * 9_000):
        assert ids(encoder.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_shared_prefixes_and_a_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 500)
    monkeypatch.setattr(byte_bpe, "PAIRS", 100)
    encoder, rng = byte_bpe.TrieEncoder(PATH), random.Random(4)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 60))) for _ in range(50)) for _ in range(10)]
        assert [ids(b) for b in encoder.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert all(len(m) < 1100 for kind in ("words", "spaced") for m in encoder.store[kind])


def test_undecodable_ids(encoder, library):
    # single bytes of a longer character
    broken = [i for i, p in enumerate(encoder.merges.pieces) if p in (b"\xe6", b"\x97", b"a")]
    blob = np.array(broken * 2, "<u4").tobytes()
    assert encoder.decode(blob) == library.decode(broken * 2, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        byte_bpe.Merges(tokenizer_path("word_bpe_49k.json"))


def digests(library, rows):
    out = []
    for doc_id, text in rows:
        own = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(own, skip_special_tokens=False)
        out.append((doc_id, len(own), hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_awkward_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "One two"), (3, "One two"), (None, "nul\x00l <|endoftext|>"), (4, "word " * 50_000), (5, "ñandú　日本")]
    docs = with_clashes(documents(spark, rows)).selectExpr("*", "'x' AS ids", "'y' AS decoded")
    got = byte_bpe.round_trip(docs, PATH)
    assert sorted(map(tuple, got.collect()), key=repr) == digests(library, rows)
    kept = byte_bpe.encoded(docs, PATH)
    assert sorted(kept.columns) == sorted(docs.columns) and kept.select("ids").first()[0] == b""
    again = byte_bpe.decoded(byte_bpe.encoded(documents(spark, rows), PATH), PATH)
    assert sorted((r["text"] or "") for r in again.collect()) == sorted(r["decoded"] for r in again.collect())
    assert byte_bpe.round_trip(documents(spark, []), PATH).collect() == []


def test_whole_table(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op13_byte_bpe(spark, folder).collect()), key=repr) == digests(library, rows)
