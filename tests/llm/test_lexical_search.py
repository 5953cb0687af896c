"""The dual tree against scores of every document with every item."""

from __future__ import annotations

import random
from collections import Counter
from math import floor, log

import numpy as np
import pytest
from tests.llm.cases import documents, with_clashes

from tunetables.llm import lexical_search as S


def brute(rows, items, k=10):
    docs = [(i, Counter(S.terms_of(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_all = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        asked = Counter(S.terms_of(text))
        found = []
        for doc_id, c in docs:
            m = 25 + 75 * c.total() * n_docs // n_all
            score = sum(
                n * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, n in asked.items()
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=repr)


def text_of(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def cases(rng, n=400):
    words = [f"w{i}" for i in range(300)] + ["The", "of", "É", "a_b"] * 20
    other = [f"v{i}" for i in range(300)] + ["le", "de"] * 30
    rows = [(i, text_of(rng, rng.randrange(0, 60), words if i % 3 else other)) for i in range(n)]
    rows += [(1000 + i, "the same copy of w1 w2 w3") for i in range(50)] + [(7, rows[7][1]), (None, "w1 w2 w9"), (None, "w1 w2 w9"), (2000, None), (2001, ""), (2002, " -!")]
    rows += [(3000, text_of(rng, 20_000, words))]
    items = [(i, text_of(rng, rng.randrange(1, 25), words if i % 2 else other)) for i in range(40)]
    items += [(50, None), (51, ""), (52, "zzz not there"), (None, "W1 w2"), (3, items[3][1]), (53, "w1 w1 w1 the")]
    return rows, items


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ranks_equal_all_scores(spark):
    rows, items = cases(random.Random(3))
    docs = with_clashes(documents(spark, rows)).selectExpr("*", "1 AS item", "2 AS score", "3 AS batch", "4 AS row", "5 AS rank")
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "'y' AS item")
    found = S.ranked_documents(docs.repartition(5), table)
    assert [f.dataType.simpleString() for f in found.schema.fields] == ["bigint", "int", "bigint", "bigint"]
    want = brute(rows, items)
    assert collected(found) == want and len(want) > 300
    assert collected(S.ranked_documents(docs, table, k=3, item_bytes=500)) == brute(rows, items, 3)


@pytest.mark.parametrize("leaf, fanout", [(1, 2), (3, 2), (32, 8), (7, 3)])
def test_any_tree(monkeypatch, leaf, fanout):
    """In one process: trees of any shape give all best documents, with and without first k-th scores."""
    monkeypatch.setattr(S, "LEAF", leaf)
    monkeypatch.setattr(S, "FANOUT", fanout)
    monkeypatch.setattr(S, "PRODUCTS", 50)
    rng = np.random.default_rng(leaf)

    def vectors(n, size):
        rows = [np.sort(rng.choice(60, rng.integers(1, size), replace=False)) for _ in range(n)]
        starts = np.cumsum([0, *map(len, rows)])
        return S.Rows(starts, np.concatenate(rows), rng.integers(0, 5, starts[-1]))

    docs, asked = vectors(130, 12), vectors(21, 9)
    scores = np.zeros((21, 130), np.int64)
    for i in range(21):
        dense = np.zeros(60, np.int64)
        dense[asked.terms[asked.starts[i] : asked.starts[i + 1]]] = asked.values[asked.starts[i] : asked.starts[i + 1]]
        scores[i] = docs.products(np.arange(130), dense)
    want = [[(int(scores[i, d]), d) for d in sorted(range(130), key=lambda d: (-scores[i, d], d)) if scores[i, d]][:10] for i in range(21)]
    first = S.Search(S.Items(list(range(21)), asked, 60), 10)
    first.add(list(range(130)), docs)
    assert first.best == want
    kth = np.array([w[9][0] if len(w) == 10 else 0 for w in want])
    again = S.Search(S.Items(list(range(21)), asked, 60), 10, kth)
    again.add(list(range(130)), docs)
    assert again.best == want
    for level in range(1, len(again.weakest)):
        below = again.weakest[level - 1]
        assert again.weakest[level].tolist() == [below[i : i + fanout].min() for i in range(0, len(below), fanout)]


def test_prunes_whole_batches(spark):
    """Documents of a language that no item has are never read."""
    docs = documents(spark, [(i, f"le de la v{i % 50}") for i in range(3000)] + [(5000 + i, f"the of w{i % 50}") for i in range(3000)])
    rows = S.written(S.counted_documents(docs, {b"le": 0, b"the": 1, b"w3": 2}), "counts")
    batches = S._batches(rows, np.array([5, 5, 900]), 6000, 22_000)
    items = S.Items([1], S.Rows(np.array([0, 2]), np.array([1, 2]), np.array([5, 900])), 3)
    able = S._bounded(batches, items, np.array([900 * 500_000]))
    assert 0 < able.count() < batches.count()


def test_nothing_to_rank(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert S.ranked_documents(documents(spark, []), items).collect() == []
    assert S.ranked_documents(documents(spark, [(1, None), (2, "three")]), items).collect() == []
    assert S.ranked_documents(documents(spark, [(1, "one")]), items.limit(0)).collect() == []
    # one document: its terms weigh floor(1000 ln(4 / 3))
    assert S.ranked_documents(documents(spark, [(1, "one")]), items).collect() == [(1, 1, 1, 287 * (10**9 // 1800))]
