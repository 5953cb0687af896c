"""Chats, preference pairs and training sets on small hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tunetables.functions import text as tx
from tunetables.operators import chats, lengths, pairs, vocab
from tunetables.plans import training_sets
from tunetables.schema import PREFERENCE, TURN
from tunetables.sources.tables import save_splits


def chat(*messages):
    return [{"role": role, "content": content} for role, content in messages]


def preference(idx, prompt, chosen, rejected):
    user = ("user", prompt)
    return (idx, "train", prompt, chat(user, ("assistant", chosen)), chat(user, ("assistant", rejected)))


LONG = "word " * 60
ROWS = [
    preference(0, "What is this?", "It is a small test row.", "I really do not know that."),
    preference(1, " \t", "It is a small test row.", "I really do not know that."),
    preference(2, "Hi there", "　\xa0", "I really do not know that."),
    preference(3, "Hi there", "Same answer as ever.", " Same answer as ever.\n"),
    preference(4, "Hi there", LONG, "I really do not know that."),
    preference(5, "Hi there", "No.", "I really do not know that."),
    preference(6, LONG, "one two three four five", "No."),
    preference(7, "w " * 40, "a b c d e", "f g h i j"),
    preference(8, "w " * 41, "a b c d e", "f g h i j"),
]
MAX_LENGTH = 50  # prompt with answer may have 45 tokens


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, PREFERENCE).cache()


def test_reasons_follow_the_order_of_checks(rows):
    got = {r.idx: r.reason for r in training_sets.pair_reasons(rows, MAX_LENGTH).collect()}
    assert got == {
        0: None, 1: "empty", 2: "empty", 3: "identical", 4: "too_long", 5: "too_short",
        6: "too_long", 7: None, 8: "too_long",
    }


def test_usable_pairs_are_those_without_a_reason(rows):
    kept = training_sets.orpo_set(rows, MAX_LENGTH)
    assert sorted(r.idx for r in kept.collect()) == [0, 7]
    counts = pairs.stage_counts(training_sets.pair_reasons(rows, MAX_LENGTH)).first()
    assert (counts.before, counts.after, counts.removed) == (9, 2, 7)


def test_prefix_is_taken_before_filters(rows):
    assert [r.idx for r in training_sets.orpo_set(rows, MAX_LENGTH, max_samples=5).collect()] == [0]
    for everything in (None, 0):
        assert pairs.first_rows(rows, everything).count() == len(ROWS)


def test_own_tokenizer_and_special_tokens(rows):
    letters = lambda texts: [len(t) for t in texts]
    counted = pairs.with_lengths(pairs.flat_pairs(rows), letters, n_special=2)
    for r in counted.collect():
        assert r.prompt_len == len(r.prompt) + 2 and r.rejected_len == len(r.rejected) + 2
    assert training_sets.orpo_set(rows, 10**6, tokenizer=letters).count() == 4


def test_short_chat_gives_null_or_raises(spark):
    row = [(0, "train", "p", chat(("user", "p")), chat(("user", "p")))]
    df = spark.createDataFrame(row, PREFERENCE)
    flat = pairs.flat_pairs(df).first()
    assert flat.chosen is None and flat.prompt == "p"
    assert training_sets.pair_reasons(df, 100).first().reason == "empty"
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        pairs.flat_pairs(df, strict=True).collect()


def test_choice_by_role_skips_a_system_message(spark):
    messages = chat(("system", "Be kind."), ("user", "Hello?"), ("assistant", "Hi!"))
    df = spark.createDataFrame([(0, "train", "Hello?", messages, messages)], PREFERENCE)
    assert pairs.references(df).first().reference == "Hello?"
    assert pairs.references(df, by_role=True).first().reference == "Hi!"
    assert tuple(pairs.flat_pairs(df, by_role=True).first())[1:] == ("Hello?", "Hi!", "Hi!")


def test_chat_template(spark):
    messages = chat(("system", "s"), ("user", "a\nb"), ("tool", "t"), ("assistant", ""))
    df = spark.createDataFrame([(0, "train", "p", messages, [])], PREFERENCE)
    text = df.select(tx.render_chat(F.col("chosen")).alias("t")).first().t
    assert text == "### User:\na\nb\n### Assistant:\n\n"


def test_training_set_by_kind(spark, tmp_path):
    other = [(r[0], split, *r[2:]) for r in ROWS for split in ("train_prefs", "train_sft", "test_prefs")]
    path = save_splits(spark.createDataFrame(other, PREFERENCE), str(tmp_path / "prefs"))
    make = lambda *args, **more: training_sets.training_set(spark, path, *args, **more)
    assert sorted(r.idx for r in make("orpo", max_length=MAX_LENGTH).collect()) == [0, 7]
    assert make("sft").columns == ["idx", "text"] and make("sft").count() == len(ROWS)
    assert make("sft", part="test").count() == 0
    words = vocab.build_vocabulary(spark.createDataFrame([("a b c",)], "text string"))
    tokenised = make("dpo", part="test", max_length=8, max_samples=3, vocabulary=words, eos_token="c").collect()
    assert sorted(r.idx for r in tokenised) == [0, 1, 2]
    assert all(len(r.chosen_input_ids) == len(r.rejected_attention_mask) == 8 for r in tokenised)
    for wrong in (lambda: make("ppo"), lambda: make("dpo")):
        with pytest.raises(ValueError):
            wrong()


def test_hot_long_chat_is_dropped_before_the_shuffle(spark):
    """One chat holds nearly all messages; the others must come through whole."""
    hot = spark.range(5000).select(
        F.lit(77).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.lit("user").alias("role"), F.lit("some words").alias("text"),
    )
    kept = training_sets.sft_set_from_turns(hot.unionByName(spark.createDataFrame(TURNS, TURN)), 20)
    assert sorted(r.conv_id for r in kept.collect()) == [1, 3]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "strategy=broadcast" in plan


TURNS = [
    (1, 0, "system", "ignored " * 500),
    (1, 1, "user", "hello there"),
    (1, 2, "assistant", "general reply"),
    (2, 0, "user", "x " * 300),
    (2, 1, "assistant", "y"),
    (3, 0, "tool", "nothing rendered"),
]


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, TURN).repartition(3)


def test_turn_lengths_add_up_to_the_whole_text(spark, turns):
    texts = chats.rendered_chats(turns).withColumn("n", tx.token_count(F.col("text")))
    whole = {r.conv_id: r.n for r in texts.collect()}
    assert whole == {r.conv_id: r.length for r in chats.chat_lengths(turns).collect()}
    assert whole[3] == 0


def test_sft_set_keeps_the_short_chats(turns):
    kept = {r.conv_id: r.text for r in training_sets.sft_set_from_turns(turns, 20).collect()}
    assert kept == {1: "### User:\nhello there\n### Assistant:\ngeneral reply\n", 3: ""}


def test_long_chat_is_rendered_in_parts(spark):
    many = spark.range(25).select(
        F.lit(9).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.lit("user").alias("role"), F.col("id").cast("string").alias("text"),
    )
    parts = chats.rendered_parts(many, part_turns=10).orderBy("part").collect()
    assert [r.part for r in parts] == [0, 1, 2]
    whole = "".join(f"### User:\n{i}\n" for i in range(25))
    assert "".join(r.text for r in parts) == whole
    assert [tuple(r) for r in chats.rendered_chats(many, part_turns=10).collect()] == [(9, whole)]


def test_one_batch_of_rows(rows):
    assert sorted(r.idx for r in pairs.batch_rows(rows, 4, 3).collect()) == [4, 5, 6]
    numbers = rows.select(pairs.batch_number(F.col("idx"), 4).alias("b")).collect()
    assert sorted(r.b for r in numbers) == [0] * 4 + [1] * 4 + [2]


def test_length_limit_is_inclusive(spark):
    df = spark.createDataFrame([(5,), (6,), (7,)], "length long")
    assert chats.short_chats(df, 6).count() == 2


@pytest.mark.parametrize("values", [[7], [1, 2, 3, 100], list(range(60)) * 3])
def test_histogram_is_numpys(spark, values):
    np = pytest.importorskip("numpy")
    df = spark.createDataFrame([(v,) for v in values], "length long")
    got = lengths.length_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r.n for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())
    summary = lengths.length_summary(df).first()
    assert summary.p95_length == pytest.approx(np.percentile(values, 95))
    assert summary.max_length == max(values) and summary.mean_length == pytest.approx(np.mean(values))


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "length long")
    assert lengths.length_histogram(empty).count() == 0
    assert lengths.length_summary(empty).first().max_length is None
