"""Near-duplicates and language-model scores against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import documents, with_clashes

from tunetables.llm import graph, lm_score, near_dup
from tunetables.llm.common import words_of
from tunetables.session import written


def shingles(text, k=4):
    words = words_of(text, lower=True)
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc_id
        out[doc_id, len(sets[i]), least, doc_id is not None and doc_id == least] += 1
    return out


def edited(rng, words, share):
    return [w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in words]


def family(rng, n, length, least, most):
    base = [f"w{rng.randrange(3000)}" for _ in range(length)]
    return [" ".join(edited(rng, base, rng.uniform(least, most))) for _ in range(n)]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    texts = family(rng, 150, 120, 0, 0.08) + family(rng, 30, 300, 0, 0.03) + [t for _ in range(40) for t in family(rng, 2, 60, 0, 0.06)]
    texts += ["One two\tthree", "one TWO three", "a b c d", "A b c d e", "É x", "é x", None, "", " \n", "same " * 50, "same " * 70] + texts[:25] * 3
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (4, "another text of one id that is like nothing"), (None, texts[7]), (None, "alone with a null id here")]
    got = near_dup.near_duplicates(with_clashes(documents(spark, rows)))
    assert Counter(tuple(r)[:4] for r in got.collect()) == brute_components(rows)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 800)
    rng = random.Random(4)
    rows = list(enumerate(family(rng, 120, 80, 0.0, 0.1)))
    got = near_dup.near_duplicates(documents(spark, rows)).collect()
    assert Counter(tuple(r)[:4] for r in got) == brute_components(rows)


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(6)
    rows = list(enumerate(family(rng, 20, 60, 0, 0.02) + family(rng, 20, 60, 0.9, 1.0))) + [(40, ""), (41, None), (41, None), (None, "null id")]
    docs = with_clashes(documents(spark, rows))
    got = near_dup.distinct_documents(docs)
    assert got.columns == docs.columns
    kept = [k for k, n in brute_components(rows).items() if k[3]]
    assert Counter(r["doc_id"] for r in got.collect()) == Counter([k[0] for k in kept] + [None])
    assert near_dup.near_duplicates(docs.limit(0)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    every = rng.integers(0, 2**63, 3000).astype(np.uint64)
    maker = near_dup.CirculantMinHash()
    same = np.mean(maker.signature(every[:2000]) == maker.signature(every[500:2500]))
    assert abs(same - 0.6) < 0.08
    assert (maker.bands([every]) == maker.bands([every[::-1]])).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 70)] + [(100, i) for i in range(101, 150)] + [(200, 201), (201, 200), (5, 5)]
    got = {r["cid"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(71), 0), **dict.fromkeys(range(100, 150), 100), 200: 200, 201: 200}


def is_held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def counted_grams(rows, order):
    """Exact counts of the n-grams of training rows, None being the end and 0 the start of a text."""
    out = Counter()
    for i, text in rows:
        if not is_held_out(i):
            padded = [0] * (order - 1) + [*words_of(text, lower=True), None]
            out.update(tuple(padded[at - k : at + 1]) for at in range(order - 1, len(padded)) for k in range(order))
            out.update((0,) * k for k in range(1, order))
    return out


def shares_after(grams, total, distinct, words, order, count):
    """P of the last of ``words`` after those before it, with ``count`` as the filter would answer."""
    share = (count(grams[words[-1:]]) + 0.5) / (total + 0.5 * (distinct + 1))
    for k in range(2, order + 1):
        share = (count(grams[words[-k:]]) + 2 * share) / (count(grams[words[-k:-1]]) + 2)
    return share


def quantised(n):
    return 0 if not n else 1.5 ** np.rint(np.log(n) / np.log(1.5))


def brute_scores(rows, order, count=quantised):
    grams = counted_grams(rows, order)
    ones = {g: n for g, n in grams.items() if len(g) == 1 and g != (0,)}
    total, distinct = sum(ones.values()), len(ones)
    out = []
    for i, text in rows:
        padded = [0] * (order - 1) + [*words_of(text, lower=True), None]
        ends = range(order - 1, len(padded))
        base = [log10((grams[padded[at],] + 0.5) / (total + 0.5 * (distinct + 1))) for at in ends]
        score = [log10(shares_after(grams, total, distinct, tuple(padded[at - order + 1 : at + 1]), order, count)) for at in ends]
        out.append((i, is_held_out(i), len(base), sum(grams[padded[at],] > 0 for at in ends), total, sum(base), sum(score)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def lm_rows():
    rng = random.Random(3)
    follow = {w: [f"v{rng.randrange(60)}" for _ in range(3)] for w in [f"v{k}" for k in range(60)]}

    def text():
        w, out = "v0", []
        for _ in range(rng.randrange(1, 300)):
            w = rng.choice(follow[w])
            out.append(w.upper() if rng.random() < 0.1 else w)
        return " ".join(out)

    return [(i, text()) for i in range(200)] + [(200, None), (201, ""), (202, " \t"), (203, "É é Zz"), (7, text()), (None, "v1 v2 v3")]


@pytest.mark.parametrize("order", [1, 3, 4])
def test_scores_equal_brute_force(spark, lm_rows, order):
    docs = with_clashes(documents(spark, lm_rows)).repartition(4)
    got = sorted((tuple(r) for r in lm_score.lm_scores(docs, order=order, merged=20_000, piece_bytes=20_000).collect()), key=str)
    want = brute_scores(lm_rows, order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    # false positives of the filter are all that differs: few n-grams are held to be a level more frequent
    gaps = np.array([abs(g[6] - w[6]) / g[2] for g, w in zip(got, want, strict=True)])
    assert gaps.max() < 0.1 and gaps.mean() < 0.02
    # against counts as they are: each P is within the rounding of its counts
    exact = brute_scores(lm_rows, order, count=lambda n: n)
    assert all(abs(g[6] - e[6]) / g[2] < order * log10(1.5**0.5) * 2 for g, e in zip(got, exact, strict=True))
    held = [g for g in got if g[1] and g[2] > 20]
    assert order == 1 or sum(g[6] for g in held) > 0.8 * sum(g[5] for g in held)


def test_probabilities_add_up(lm_rows):
    """With exact counts to 1, with those that the filter stands for to between 1/1.5 and 1.5."""
    grams = counted_grams(lm_rows, 3)
    ones = {g: n for g, n in grams.items() if len(g) == 1 and g != (0,)}
    every = [*[g[0] for g in ones], "never seen"]
    for context in [(0, 0), (0, "v0"), *[g for g in grams if len(g) == 2 and None not in g][:40]]:
        sums = [sum(shares_after(grams, sum(ones.values()), len(ones), (*context, w), 3, count) for w in every) for count in (lambda n: n, quantised)]
        assert sums[0] == pytest.approx(1)
        assert 1 / 1.5 < sums[1] < 1.5


def test_pieces_and_chunks_change_nothing(spark, lm_rows, monkeypatch):
    docs = documents(spark, lm_rows).repartition(3)
    whole = lm_score.lm_scores(docs).collect()
    monkeypatch.setattr(lm_score, "CHUNK", 4000)
    asked = []
    monkeypatch.setattr(lm_score, "written", lambda df, label: asked.append(label) or written(df, label))
    parts = lm_score.lm_scores(docs, merged=20_000, piece_bytes=20_000).collect()
    assert asked == ["lm-chunks", "lm-words"]
    known = lambda rows: sorted((tuple(r)[:5] for r in rows), key=str)
    assert known(whole) == known(parts)
    # other shards have other false positives, which count in every text of these few n-grams
    assert sum(r["score"] for r in whole) == pytest.approx(sum(r["score"] for r in parts), rel=0.02)


def test_scores_without_rows_or_training(spark):
    assert lm_score.lm_scores(documents(spark, [])).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    [row] = lm_score.lm_scores(documents(spark, [(only, "a b")])).collect()
    assert tuple(row)[:5] == (only, True, 3, 0, 0)


def test_bloom_holds_counts():
    rng = np.random.default_rng(0)
    keys, counts = rng.integers(0, 2**63, 20_000).astype(np.uint64), rng.integers(1, 3000, 20_000)
    bloom = lm_score.LogFrequencyBloom.empty(int(lm_score.levels(counts).sum()))
    bloom.add(keys, lm_score.levels(counts))
    got = bloom.count(keys)
    want = lm_score.estimates(lm_score.levels(counts))
    assert (np.abs(np.log(want / counts)) <= np.log(1.5) / 2 + 1e-9).all()
    assert (got >= want).all() and np.mean(got == want) > 0.99
    assert np.mean(bloom.count(rng.integers(0, 2**63, 20_000).astype(np.uint64)) > 0) < 0.01


def test_held_out_by_id(spark):
    rows = spark.range(50).select("id", lm_score.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 1) for r in rows)


def test_chunks_hold_all_rows(spark, lm_rows):
    chunks = lm_score._chunks(documents(spark, lm_rows * 3).repartition(2)).collect()
    assert len(chunks) == 2 and len({r["chunk"] for r in chunks}) == 2
    rows = [lm_score._unpacked(r["n"], *(bytes(r[c]) for c in ("rows", "words", "codes"))) for r in chunks]
    assert sum(len(r[0]) for r in rows) == sum(len(r[3]) for r in rows) == 3 * len(lm_rows)
    ends = [words[codes[np.append(firsts[1:], len(codes)) - 1]] for _, words, codes, firsts in rows]
    assert all((e == lm_score.END).all() for e in ends)


def test_keys_by_their_gaps():
    for keys in ([], [5], [0, 1, 2**63, 2**64 - 1], range(0, 10**6, 1000)):
        keys = np.array(keys, np.uint64)
        assert (lm_score._keys(lm_score._gaps(keys), len(keys)) == keys).all()


def test_places_by_upper_bits():
    rng = np.random.default_rng(1)
    for bits, n in ((32, 1), (32, 5), (40, 100_000), (63, 100_000)):
        own = rng.integers(0, 2**bits, n).astype(np.uint64)
        crowded = np.concatenate([own, np.arange(50, dtype=np.uint64), np.uint64(2**bits - 1) - np.arange(3, dtype=np.uint64), own])
        every = lm_score._distinct(crowded)
        assert (every == np.unique(crowded)).all()
        assert (lm_score._found(every, crowded, bits) == np.searchsorted(every, crowded)).all()


def test_each_text_counts_its_start():
    rows = [("a b", False), ("a", True), ("", False)]
    tokens = lm_score._tokens([t for t, _ in rows])
    words, codes = np.unique(np.concatenate(tokens), return_inverse=True)
    frame = pd.DataFrame({"held_out": [h for _, h in rows], "n_tokens": [len(t) for t in tokens]})
    firsts = np.cumsum(frame["n_tokens"]).to_numpy() - frame["n_tokens"].to_numpy()
    keys, counts = lm_score._ngrams(3, 40)(frame, words, codes, firsts)
    grams, starts = lm_score._grams(words[codes], firsts, 3, 40)
    assert (keys == np.unique(np.concatenate([*grams, starts]))).all()
    # two training texts of three and one tokens: both starts, and three grams a token
    assert counts[np.searchsorted(keys, starts)].tolist() == [2, 2]
    assert counts.sum() == 2 * 2 + 3 * 4
