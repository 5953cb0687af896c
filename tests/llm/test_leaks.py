"""Benchmark leaks against a scan of every passage with every item."""

from __future__ import annotations

import random

from tests.llm.cases import documents, with_clashes

from tunetables.llm import decontaminate as D


def text_of(rng, n):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else f"w{rng.randrange(2500)}" for _ in range(n))


def brute(rows, items):
    """Pairs by shingles alone, over passages as long as the operator's."""
    split = {i: D.question_and_answer(t) for i, t in items}
    passage = max(64, 2 * max(len(q) + len(a) for q, a in split.values()))
    out = set()
    for doc_id, text in rows:
        words = [D._term(w) for w in D.split_words(text)]
        for first in range(0, len(words), passage // 2):
            part = words[first : first + passage]
            for i, (q, a) in split.items():
                there = {tuple(part[k : k + n]) for n in range(1, 6) for k in range(len(part) - n + 1)}
                share = [len(s & there) / len(s) if s else 1.0 for s in (D._shingles(q), D._shingles(a))]
                if (q or a) and share[0] >= D.QUESTION and share[1] >= D.ANSWER:
                    out.add((doc_id, i))
    return out


def cases(rng):
    items = [(i, text_of(rng, rng.randrange(8, 60)) + (". " + text_of(rng, 6) if i % 2 else "")) for i in range(60)]
    items += [(60, ""), (61, None), (62, items[3][1]), (63, "  \n ")]
    rows = [(i, text_of(rng, rng.randrange(0, 400))) for i in range(150)]
    for k in range(40):
        item = items[rng.randrange(60)][1]
        words = item.split(" ")
        if k % 4 == 1:
            words[rng.randrange(len(words))] = "changed"
        if k % 4 == 2:
            words = words[: len(words) // 2]
        body = " ".join(words).upper() if k % 4 == 3 else " ".join(words)
        rows.append((200 + k, text_of(rng, rng.randrange(300)) + ' "' + body + '!" ' + text_of(rng, rng.randrange(300))))
    return rows + [(300, None), (301, ""), (302, items[5][1]), (302, items[5][1])], items


def test_leaks_equal_a_scan(spark):
    rng = random.Random(12)
    rows, items = cases(rng)
    docs = with_clashes(documents(spark, rows))
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id")
    want = brute([r for r in rows if r[1]], [i for i in items if (i[1] or "").strip()])
    got = D.leaks(docs, table).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 25
    assert len(got) == len(want) + sum(p[0] == 302 for p in want)
    split = D.leaks(docs, table, index_bytes=3000).collect()
    assert {(r["doc_id"], r["item_id"]) for r in split} >= want
    clean = D.clean_documents(docs, table)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in rows if i not in {p[0] for p in want})


def test_bounds_hide_nothing(spark, monkeypatch):
    """Every score that the full index reaches is found when terms are looked up lazily."""
    rng = random.Random(5)
    rows, items = cases(rng)
    table = spark.createDataFrame(items, "item_id long, text string")
    lazy = {(r["doc_id"], r["item_id"], round(r["score"], 9)) for r in D.retrieved_items(documents(spark, rows), table).collect()}
    monkeypatch.setattr(D, "IDLE", -1.0)
    monkeypatch.setattr(D, "POSTINGS", 1000)
    full = {(r["doc_id"], r["item_id"], round(r["score"], 9)) for r in D.retrieved_items(documents(spark, rows), table).collect()}
    assert lazy == full and len(full) > 25


def test_nothing_to_compare(spark):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert D.leaks(documents(spark, []), items).collect() == []
    docs = documents(spark, [(1, "one two three four five six seven"), (None, "One two, three four five six")])
    assert {r["doc_id"] for r in D.leaks(docs, items).collect()} == {1, None}
    assert D.leaks(docs, items.limit(0)).collect() == []
    assert [r["doc_id"] for r in D.clean_documents(docs, items).collect()] == [None]
