"""Text scores against plain-Python definitions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.fixtures import text_pairs
from tests import brute
from tunetables.functions import lcs
from tunetables.functions.text import BLEU_STEPS, WHITESPACE, bleu_tokens, rouge_tokens, strip
from tunetables.operators import embedding_match, ngrams, rouge_lcs, score_tables
from tunetables.schema import SCORED_PAIR

PAIRS = [
    (0, "the cat sat on the mat.", "the cat sat on the mat."),
    (1, "", "something"),
    (2, "", ""),
    (3, "a b c\nd e f", "d e\na b c\nf"),
    (4, "Prices rose 1,000.5% - 3-4 times &quot;x&quot;", "prices fell 1,000.5 % 3 - 4 times"),
    (5, "été à la plage", "ete a la plage"),
    (6, "one", "two"),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "pair_id long, prediction string, reference string").cache()


def test_lcs_matches_table():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice("abcdef") for _ in range(rng.randrange(40))]
        b = [rng.choice("abcdefg") for _ in range(rng.randrange(40))]
        assert lcs.lcs_length(a, b) == brute.table(a, b)[-1][-1]
        assert lcs.lcs_places(a, lcs._masks(b), b) == brute.places(a, b)


def test_lcs_places_rebuilds_rows_of_long_lists(monkeypatch):
    monkeypatch.setattr(lcs, "_KEEP_ALL_BITS", 1000)
    rng = random.Random(2)
    a = [rng.choice("abcdefgh") for _ in range(700)]
    b = [rng.choice("abcdefghij") for _ in range(500)]
    assert lcs.lcs_places(a, lcs._masks(b), b) == brute.places(a, b)


@pytest.mark.parametrize("name", ["rougeL", "rougeLsum"])
def test_lcs_scores(pairs, name):
    add = rouge_lcs.with_rouge_l if name == "rougeL" else rouge_lcs.with_rouge_lsum
    exact = brute.rouge_l if name == "rougeL" else brute.rouge_lsum
    for row in add(pairs).collect():
        assert row[name] == pytest.approx(exact(row.prediction, row.reference)), row.pair_id


@pytest.mark.parametrize("name", ["rougeL", "rougeLsum"])
def test_lcs_scores_on_shared_documents(spark, name):
    """The registered queries, over the whole smallest tables."""
    from catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    query = "f04_rouge_l" if name == "rougeL" else "f05_rouge_lsum"
    exact = brute.rouge_l if name == "rougeL" else brute.rouge_lsum
    got = {r.pair_id: r[name] for r in QUERIES[query](spark, folder).collect()}
    short = [r for r in text_pairs(spark, folder).collect() if len(r.prediction) + len(r.reference) < 4000]
    assert len(got) == text_pairs(spark, folder).count() and len(short) > 20
    for r in short:
        assert got[r.pair_id] == pytest.approx(exact(r.prediction, r.reference), abs=1e-6)


def test_corpus_subsequence_scores(spark):
    """The registered corpus figures, against the mean of exact pair scores."""
    from catalog import QUERIES
    from catalog.fixtures import prefs
    from catalog.scores import load_stub

    folder, answer = "/root/testdata/sf0.001", load_stub()
    rows = prefs(spark, folder).select("prompt", "chosen").collect()
    got = {r.metric: r.value for r in QUERIES["f09_evaluation_subsequence_scores"](spark, folder).collect()}
    for name, exact in (("rougeL", brute.rouge_l), ("rougeLsum", brute.rouge_lsum)):
        scores = [exact(answer([r.prompt])[0], r.chosen) for r in rows]
        assert got[name] == pytest.approx(sum(scores) / len(scores), abs=1e-6)
    pair_scores = [r.rougeL for r in QUERIES["f04_rouge_l"](spark, folder).collect()]
    short = {r.metric: r.value for r in QUERIES["f08_short_scores"](spark, folder).collect()}
    assert short["rougeL"] == pytest.approx(sum(pair_scores) / len(pair_scores), abs=1e-6)


def test_identical_texts_score_one(spark):
    text = "the quick brown fox jumps over the lazy dog"
    same = spark.createDataFrame([(0, text, text)], "pair_id long, prediction string, reference string")
    score = ngrams.corpus_bleu(same).first()
    assert score.bleu == pytest.approx(1) and score.brevity_penalty == 1
    assert ngrams.rouge_n(same).first().rouge2 == 1


def test_every_pair_is_scored(pairs):
    found = {r.pair_id: r for r in ngrams.rouge_n(pairs).collect()}
    assert sorted(found) == [p[0] for p in PAIRS]
    assert found[2].rouge1 == 0 and found[1].rouge1 == 0 and found[0].rouge2 == 1


def test_f1_is_symmetric(pairs):
    turned = pairs.select("pair_id", F.col("reference").alias("prediction"), F.col("prediction").alias("reference"))
    assert sorted(ngrams.rouge_n(pairs).collect()) == sorted(ngrams.rouge_n(turned).collect())


def test_bleu_by_group(spark):
    rows = [("a", 0, "x y z w v", "x y z w v"), ("b", 1, "x y", "p q")]
    df = spark.createDataFrame(rows, "experiment string, pair_id long, prediction string, reference string")
    got = {r.experiment: r.bleu for r in ngrams.corpus_bleu(df, by=["experiment"]).collect()}
    assert got["a"] == pytest.approx(1) and got["b"] == 0


def test_bleu_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, "", "a b")], "pair_id long, prediction string, reference string")
    score = ngrams.corpus_bleu(df).first()
    assert score.bleu == 0 and score.translation_length == 0 and score.reference_length == 2


def test_tiles_do_not_change_matches(spark):
    rng = np.random.default_rng(0)
    rows = []
    for pair in range(3):
        for side, n in (("pred", 7 + pair), ("ref", 9)):
            rows += [(pair, side, i, rng.normal(size=5).tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "pair_id long, side string, pos long, embedding array<float>")
    whole = {(r.pair_id, r.side, r.pos): r.best for r in embedding_match.greedy_matches(df).collect()}
    tiled = {(r.pair_id, r.side, r.pos): r.best for r in embedding_match.greedy_matches(df, tile=4).collect()}
    assert len(whole) == len(rows) and whole.keys() == tiled.keys()
    for key, best in whole.items():
        vec = {(r[0], r[1], r[2]): np.float32(r[3]).astype(float) for r in rows}
        other = "ref" if key[1] == "pred" else "pred"
        unit = lambda v: v / np.linalg.norm(v)
        exact = max(unit(vec[key]) @ unit(v) for k, v in vec.items() if k[0] == key[0] and k[1] == other)
        assert best == pytest.approx(exact) and tiled[key] == pytest.approx(exact)


def test_a_pair_with_an_empty_side_scores_zero(spark):
    rows = [(0, "pred", 0, [1.0, 0.0]), (1, "pred", 0, [1.0, 0.0]), (1, "ref", 0, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "pair_id long, side string, pos long, embedding array<float>")
    got = {r.pair_id: (r.precision, r.recall, r.f1) for r in embedding_match.embedding_scores(df).collect()}
    assert got == {0: (0, 0, 0), 1: (1, 1, 1)}


def test_bootstrap_interval(spark):
    """The interval holds the median, narrows with more pairs, and is one value for one pair."""
    rng = random.Random(6)
    rows = [(i, i % 2, rng.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "pair_id long, half long, s double")
    whole = score_tables.bootstrap_scores(df, ["s"], resamples=201, confidence=0.9).first()
    part = score_tables.bootstrap_scores(df.where("pair_id < 90"), ["s"], resamples=201, confidence=0.9).first()
    assert whole.s_low < whole.s < whole.s_high and whole.s_high - whole.s_low < part.s_high - part.s_low
    # nine tenths of the means lie within 1.645 standard errors on either side
    error = (sum((s - 0.5) ** 2 for _, _, s in rows) / 900 / 900) ** 0.5
    assert 2.6 * error < whole.s_high - whole.s_low < 4.2 * error
    grouped = score_tables.bootstrap_scores(df, ["s"], ["half"], resamples=50)
    assert grouped.count() == 2 and grouped.columns == ["half", "s"]
    one = score_tables.bootstrap_scores(df.where("pair_id = 4"), ["s"], resamples=50, confidence=0.9).first()
    assert one.s_low == pytest.approx(rows[4][2]) and one.s_high == pytest.approx(rows[4][2])


def test_bootstrap_is_repeatable_and_near_the_mean(spark):
    df = spark.range(400).select(F.col("id").alias("pair_id"), (F.col("id") % 10 / 10).alias("s"))
    one = score_tables.bootstrap_scores(df, ["s"], resamples=200).first().s
    two = score_tables.bootstrap_scores(df.repartition(5), ["s"], resamples=200).first().s
    assert one == pytest.approx(two) and one == pytest.approx(0.45, abs=0.02)


def test_non_numbers_count_as_zero(spark):
    df = spark.createDataFrame([(0.5, "n/a", None)], "a double, b string, c double")
    got = {r.metric: r.value for r in score_tables.long_scores(df, ["a", "b", "c"]).collect()}
    assert got == {"a": 0.5, "b": 0.0, "c": 0.0}


def bleu_words(text):
    """The four substitutions, by Python's engine."""
    import re

    text = text.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = text.replace(entity, char)
    text = f" {text} "
    for pattern, by in BLEU_STEPS:
        text = re.sub(pattern, by.replace("$", "\\"), text)
    return text.split()


def test_bleu_words_of_any_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("a1.,-! \n\té\xa0&;/_'") for _ in range(rng.randrange(1, 14))) for _ in range(20000)]
    texts += ["".join(rng.choice("5.,-") for _ in range(rng.randrange(1, 8))) for _ in range(5000)]
    texts += ["a,.5", "1..2", "5.,.6", "1,000.5-3", "x <skipped>y-\nz &quot;q&quot; &amp;lt;", "", ".", "　"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", bleu_tokens(F.col("t")).alias("w"))
    wrong = [(r.t, r.w) for r in df.collect() if r.w != bleu_words(r.t)]
    assert not wrong, wrong[:5]


def test_strip_is_python_strip(spark):
    texts = [f"{c}x{c}y{c}" for c in WHITESPACE] + ["", "   ", "​x​", "\x00 x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"))
    assert all(r.s == r.t.strip() for r in df.collect())


def test_rows_with_one_key_count_as_one_pair(spark):
    rows = [(1, "a b", "b c"), (1, "c", "a a"), (None, "x", "x"), (None, "x", None), (2, "", None), (3, "a b c", "a b")]
    got = ngrams.overlaps(spark.createDataFrame(rows, "pair_id long, prediction string, reference string"), rouge_tokens, 2)
    assert {(r.pair_id, r.n): (r.overlap, r.n_prediction, r.n_reference) for r in got.collect()} == {
        (1, 1): (3, 3, 4), (1, 2): (0, 1, 2), (None, 1): (1, 2, 1), (2, 1): (0, 0, 0), (3, 1): (2, 3, 2), (3, 2): (1, 2, 1),
    }


def test_grams_never_become_rows(spark):
    """Exploded positions were grouped by gram, which spilled many times the texts."""
    plan = ngrams.corpus_bleu(spark.createDataFrame([(1, "a", "b")], SCORED_PAIR))._jdf.queryExecution().executedPlan().toString()
    assert "gram#" not in plan and plan.count("Generate inline") == 1


def test_counts_do_not_depend_on_slices(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * i) % 7}" for i in range(k)), "w1 w2 w3 w1 w2") for k in range(60)]
    df = spark.createDataFrame(rows, "pair_id long, prediction string, reference string")
    want = sorted(ngrams.overlaps(df, rouge_tokens, 3).collect())
    monkeypatch.setattr(ngrams, "SLICE_WORDS", 5)
    assert sorted(ngrams.overlaps(df, rouge_tokens, 3).collect()) == want
    grams = ngrams.gram_counts(df, rouge_tokens, 3).where("pair_id = 2").collect()
    assert {(r.n, r.gram): (r.in_prediction, r.in_reference) for r in grams} == {
        (1, "w0"): (1, 0), (1, "w1"): (0, 2), (1, "w2"): (1, 2), (1, "w3"): (0, 1), (2, "w0 w2"): (1, 0),
        (2, "w1 w2"): (0, 2), (2, "w2 w3"): (0, 1), (2, "w3 w1"): (0, 1),
        (3, "w1 w2 w3"): (0, 1), (3, "w2 w3 w1"): (0, 1), (3, "w3 w1 w2"): (0, 1),
    }
