"""Suffix arrays and the removal of repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tests.llm.cases import documents, with_clashes

from tunetables.llm import substring_dup
from tunetables.llm.suffix import common_prefixes, gram_hashes, suffix_array


def some_bytes(rng, kind):
    if kind == "periodic":
        return b"abc" * 200 + b"x" * 300
    if kind == "zeros":
        return bytes(500)
    if kind == "copies":
        part = bytes(rng.randrange(256) for _ in range(150))
        return b"".join(part[rng.randrange(80) :] + bytes([rng.randrange(3)]) for _ in range(12))
    return bytes(rng.choice(b"ab") for _ in range(700))


@pytest.mark.parametrize("kind", ["periodic", "zeros", "copies", "letters"])
@pytest.mark.parametrize("depth", [8, 50, 64, 400])
def test_suffix_array_and_prefixes(kind, depth):
    data = some_bytes(random.Random(1), kind)
    text = np.frombuffer(data, np.uint8)
    order = suffix_array(text, depth)
    assert sorted(order.tolist()) == list(range(len(data)))
    heads = [data[i : i + depth] for i in order]
    # zeros that pad the first eight bytes can only confuse suffixes that end there
    assert all(a <= b for a, b in zip(heads, heads[1:], strict=False) if len(a) == depth and len(b) == depth)

    def shared(a, b):
        n = 0
        while n < depth and max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        return n

    want = [0, *(shared(a, b) for a, b in zip(order[:-1], order[1:], strict=True))]
    assert common_prefixes(text, order, depth, stride=16).tolist() == want


@pytest.mark.parametrize("length", [1, 7, 8, 13, 400])
def test_gram_hashes(length):
    text = np.frombuffer(some_bytes(random.Random(2), "copies"), np.uint8)
    got = gram_hashes(text, length)
    grams = [text[i : i + length].tobytes() for i in range(len(text) - length + 1)]
    assert len(got) == len(grams)
    assert len(set(got.tolist())) == len(set(grams)) == len(set(zip(got.tolist(), grams, strict=True)))


def brute(rows, length):
    blobs = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in blobs for i in range(len(b) - length + 1))
    out = Counter()
    for (doc_id, _), b in zip(rows, blobs, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out[doc_id, len(b), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(rng):
    word = lambda: rng.choice(["é", "the", "of", "ßa", "x"]) + str(rng.randrange(4000))
    passage = " ".join(word() for _ in range(60))
    long = " ".join(word() for _ in range(200))
    out = [None, "", "short", "a" * 1500, "ab" * 500, passage, " \n "]
    for _ in range(40):
        words = [word() for _ in range(rng.randrange(1, 120))]
        out.append(" ".join(words) + passage[rng.randrange(40) : -rng.randrange(1, 90)] + " ".join(words[: rng.randrange(60)]))
    for _ in range(15):
        words = long.split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = word()
        out.append(" ".join(words))
    return out + out[-3:] + [out[10]] * 4 + ["😀" * 300]


@pytest.mark.parametrize(("length", "anchor", "most"), [(400, 128, 512), (100, 32, 4), (60, 16, 512)])
def test_removal_equals_brute_force(spark, length, anchor, most):
    rng = random.Random(7)
    rows = list(enumerate(corpus(rng)))
    rows += [rows[9], (None, rows[12][1]), (None, None)]
    docs = with_clashes(documents(spark, rows)).repartition(6)
    cut = substring_dup.cut_documents(docs, length=length, anchor=anchor, shard=20_000, most=most)
    assert Counter(map(tuple, substring_dup.removal_digest(cut).collect())) == brute(rows, length)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(substring_dup, "PIECE", 1500)
    rng = random.Random(9)
    part = " ".join(str(rng.randrange(10**6)) for _ in range(700))
    rows = [(1, part + " middle " + part[1000:3000]), (2, "q " + part[2500:2950] + " é"), (3, " ".join(str(rng.randrange(10**6)) for _ in range(900)))]
    cut = substring_dup.cut_documents(documents(spark, rows))
    assert Counter(map(tuple, substring_dup.removal_digest(cut).collect())) == brute(rows, 400)


def test_nothing_to_remove(spark):
    assert substring_dup.cut_documents(documents(spark, [])).collect() == []
    [row] = substring_dup.cut_documents(documents(spark, [(1, "only one")])).collect()
    assert (row["spans"], bytes(row["kept"])) == ([], b"only one")


def test_equal_rows_meet_once(spark, monkeypatch):
    """Thousands of equal rows are one set of contexts for the suffix arrays, and all of them are cut."""
    rng = random.Random(7)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    rows = [(5, text)] * 3000 + [(i, text) for i in range(100, 400)] + [(6, "other " + text[:700]), (7, "something else entirely")]
    kept, written = {}, substring_dup.written

    def noted(df, label):
        kept[label] = written(df, label)
        return kept[label]

    monkeypatch.setattr(substring_dup, "written", noted)
    cut = substring_dup.removal_digest(substring_dup.cut_documents(documents(spark, rows))).collect()
    assert len(cut) == len(rows)
    own = len(substring_dup.anchored([text.encode()], 400, 128)[0])
    assert kept["dup-live"].count() > 3000 * own / 2
    assert kept["dup-shards"].count() <= 2 * own + 4
    assert {r["n_removed"] for r in cut if r["doc_id"] in (5, 100, 399)} == {len(text)}
    assert {(r["doc_id"], r["n_removed"]) for r in cut if r["doc_id"] in (6, 7)} == {(6, 700), (7, 0)}
