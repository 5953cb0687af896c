"""The stages one after the other, with ids that are null or stand for several texts."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest
from tests.llm.cases import documents, labels, with_clashes

from tunetables.llm import decontaminate, mixing, near_dup

ITEM = "which of the nine old bridges over the river was built first by the masons of the town"


def words(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


def test_rows_without_id_are_clean(spark):
    rng = random.Random(2)
    held = words(rng, 40) + " " + ITEM + " " + words(rng, 30)
    rows = [(1, held), (1, "another text of this id " + words(rng, 30)), (None, held), (None, "no item here"), (None, None), (2, "")]
    docs = with_clashes(documents(spark, rows))
    got = decontaminate.clean_rows(docs, spark.createDataFrame([(7, ITEM)], "item_id long, text string"))
    assert got.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(r for r in rows if r[1] != held)


def test_one_row_of_each_group_without_ids(spark):
    rng = random.Random(3)
    base = words(rng, 120).split()
    near = [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in (5, 20)]
    other = words(rng, 50)
    alone = words(rng, 50)
    rows = [(None, near[0])] * 3 + [(None, near[1])] + [(9, other), (4, other), (None, other), (4, alone), (9, alone)]
    rows += [(None, ""), (None, ""), (5, " "), (5, " ")]
    got = Counter((r["doc_id"], r["text"]) for r in near_dup.distinct_documents(documents(spark, rows)).collect())
    assert sum(got[None, t] for t in near) == 1
    assert {k: n for k, n in got.items() if k[1] not in near} == {(4, other): 1, (4, alone): 1, (None, ""): 2, (5, " "): 1}


def test_links_through_rows_without_id(spark):
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    steps = [" ".join(base[k : k + 150]) for k in (0, 14, 28)]  # neighbours share over 0.8, the ends under
    rows = [(1, steps[0]), (None, steps[1]), (3, steps[2]), (4, words(rng, 80))]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {1: 1, None: 1, 3: 1, 4: 4}


def test_pipeline_run(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(5)
    texts = [words(rng, 300) for _ in range(40)]
    held = words(rng, 200) + " " + ITEM + " " + words(rng, 100)
    copy = texts[0].replace(texts[0].split()[50], "changed", 1)
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(texts)] + [(None, held, "a"), (None, copy, "a"), (50, held, "b"), (51, "short", "b")]
    folder = str(tmp_path)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels(spark, [(i, 1, 0) for i in range(40)]).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = documents(spark, rows)
    left = []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        left.append(Counter((r["doc_id"], r["text"]) for r in docs.collect()))
    good = Counter((i, t) for i, t in enumerate(texts))
    assert left[0] == good + Counter([(None, held), (None, copy), (50, held)])
    assert left[1] == good + Counter([(50, held)])
    assert left[2] == good
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect())
    assert set(got) <= set(range(40)) and len(got) >= 20


def test_parts_of_long_texts_are_taken(spark):
    rows = [(1, "\t".join(f"a{k}" for k in range(1000)), "one"), (None, " ".join(f"b{k}" for k in range(700)), "two"), (None, " ".join(f"b{k}" for k in range(700)), "two")]
    rows += [(i, f"c{i} " * (1 + i % 60), "many") for i in range(10, 400)] + [(5, "", "many"), (6, None, None)]
    docs = with_clashes(documents(spark, rows))
    for options in ({}, {"share": 0.3}, {"block": 7, "shard": 50}):
        takes = mixing.mix(docs, **options).collect()
        got = mixing.mixed_texts(docs, **options).collect()
        assert got[0].asDict().keys() == set(docs.columns) and got[0]["size"] == "kept size"
        want, words = Counter(), Counter()
        for r in takes:
            want[r["doc_id"]] += r["taken"]
        for r in got:
            words[r["doc_id"]] += len(r["text"].split())
            assert r["n_chars"] == len(r["text"])
            assert any(r["text"].strip() in (t or "") for i, t, *_ in rows if i == r["doc_id"])
        assert +words == +want
    assert any(0 < r["taken"] % r["size"] for r in takes if r["size"])
