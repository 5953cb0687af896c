"""Vocabularies, packing, generation, reports, streaming, storage."""

from __future__ import annotations

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from catalog.fixtures import table, trainer_raw
from tunetables import session
from tunetables.operators import generation, packing, records, reports, vocab
from tunetables.plans import evaluation
from tunetables.schema import SCORED_PAIR
from tunetables.sources import sinks, tables
from tunetables.streaming import runlogs as live

TEXTS = [(0, "b a a c"), (1, ""), (2, "a b unknown?"), (5, "c c c c c c c")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "idx long, text string")


@pytest.fixture(scope="module")
def words(spark, texts):
    return vocab.stored_vocabulary(vocab.build_vocabulary(texts.where("idx <> 2")))


def test_vocabulary_order(spark, texts, words):
    assert {r.token: (r.freq, r.id) for r in words.collect()} == {"c": (8, 1), "a": (2, 2), "b": (1, 3)}
    top = vocab.build_vocabulary(texts, size=2)
    assert {r.token: r.id for r in top.collect()} == {"c": 1, "a": 2}


def test_encode_and_decode(texts, words):
    coded = vocab.encode(texts, words, ["text"])
    assert {r.idx: r.text_ids for r in coded.collect()} == {
        0: [3, 2, 2, 1], 1: [], 2: [2, 3, 0, 0], 5: [1] * 7,
    }
    plain = vocab.decode(coded, words, "text_ids", prompt_len=F.lit(1), special_tokens=["a"])
    assert {r.idx: r.text for r in plain.collect()} == {
        0: "c", 1: "", 2: "b <unk> <unk>", 5: "c c c c c c",
    }


@pytest.mark.parametrize("side", ["left", "right"])
def test_fixed_length(texts, words, side):
    coded = vocab.encode(texts, words, ["text"], max_length=5)
    for r in vocab.fixed_length(coded, ["text"], 5, F.lit(9), side).collect():
        n = min(5, len(vocab_tokens(r.idx)))
        assert len(r.text_input_ids) == len(r.text_attention_mask) == 5
        assert sum(r.text_attention_mask) == n
        pad = r.text_input_ids[: 5 - n] if side == "left" else r.text_input_ids[n:]
        assert pad == [9] * (5 - n)
    with pytest.raises(ValueError):
        vocab.padded(F.col("text_ids"), F.lit(5), F.lit(0), "middle")


def vocab_tokens(idx):
    return {0: ["b", "a", "a", "c"], 1: [], 2: ["a", "b", "unknown", "?"], 5: ["c"] * 7}[idx]


def test_pad_token_falls_back(words):
    assert vocab.pad_token_id(words, None, "a").first().pad_id == 2
    assert vocab.pad_token_id(words, "<pad>", "b").first().pad_id == 3
    assert vocab.pad_token_id(words, "c", "b").first().pad_id == 1


def test_batches_pad_to_their_longest(spark):
    df = spark.createDataFrame([(0, [1]), (1, [1, 2, 3]), (2, [4, 5])], "idx long, ids array<int>")
    got = {r.idx: r.ids for r in vocab.pad_batches(df, 2, F.lit(0)).collect()}
    assert got == {0: [0, 0, 1], 1: [1, 2, 3], 2: [4, 5]}


@pytest.mark.parametrize("block", [1, 4, 7, 1000])
def test_packing_keeps_every_token_in_order(spark, block):
    rows = [(i * 3, list(range(i % 11))) for i in range(60)]
    df = spark.createDataFrame(rows, "idx long, ids array<int>").repartition(5)
    stream = [t for _, ids in rows for t in ids]
    got = packing.pack(df, "ids", block).orderBy("block").collect()
    assert [t for r in got for t in r.ids] == stream
    assert all(r.n_tokens == block for r in got[:-1])
    assert [r.block for r in got] == list(range(-(-len(stream) // block)))


def prompts(spark, n=23):
    return spark.range(n).select(F.col("id").alias("idx"), F.concat(F.lit("p"), "id").alias("prompt"))


def test_generation_batches(spark):
    def load():
        def answer(batch):
            assert len(batch) <= 4
            return [f"{p}/{len(batch)}" for p in batch]

        return answer

    got = generation.generated(prompts(spark).coalesce(1), load, batch_size=4).collect()
    assert [r.prediction for r in got][:5] == ["p0/4", "p1/4", "p2/4", "p3/4", "p4/4"]
    assert got[-1].prediction == "p22/3" and len(got) == 23
    spread = generation.generated(prompts(spark), load, batch_size=4, tasks=5, by_length=True)
    assert sorted(r.idx for r in spread.collect()) == list(range(23))


def batch_sensitive():
    """Answers that show the whole batch they were given in."""
    return lambda batch: [f"{p} of {'|'.join(batch)}" for p in batch]


@pytest.mark.parametrize("by_length", [False, True])
def test_generation_does_not_depend_on_the_cluster(spark, by_length):
    rows = spark.range(103).select(F.col("id").alias("idx"), F.repeat(F.lit("x"), (F.col("id") * 7 % 13).cast("int")).alias("prompt"), F.lit(1).alias("_place"))
    found = []
    try:
        for parts, tasks, records in ((1, 1, 10_000), (5, 4, 3), (9, 8, 5), (2, None, 1)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            some = generation.generated(rows.drop("_place").repartition(parts), batch_sensitive, batch_size=4, tasks=tasks, by_length=by_length)
            found.append(sorted(map(tuple, some.collect())))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(f == found[0] for f in found) and len(found[0]) == 103
    if not by_length:
        prompts_of = [p for _, p, _ in found[0]]
        assert [a for _, _, a in found[0]] == [f"{p} of {'|'.join(prompts_of[i // 4 * 4 : i // 4 * 4 + 4])}" for i, p in enumerate(prompts_of)]
    else:
        lengths = [{len(p) for p in a.split(" of ")[1].split("|")} for _, _, a in found[0]]
        assert max(max(n) - min(n) for n in lengths) <= 1


def test_rows_without_or_with_equal_keys_are_answered(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (3, "c"), (3, "d"), (3, "e")], "key long, text string")
    got = generation.generated(rows, batch_sensitive, batch_size=2, column="text", key="key").collect()
    assert sorted((r.text, r.prediction) for r in got) == [("a", "a of a|b"), ("b", "b of a|b"), ("c", "c of c|d"), ("d", "d of c|d"), ("e", "e of e")]
    assert generation.generated(rows.limit(0), batch_sensitive, column="text", key="key").collect() == []


def test_a_worker_loads_its_model_once(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda batch: batch

    # sixteen tasks on eight cores
    assert generation.generated(prompts(spark, 160), load, tasks=16).count() == 160
    loaded = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loaded) == len(set(loaded)) and len(loaded) < 16


def test_stage_resources_reach_spark(spark):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
    # a local session has no executors to ask for, and says so
    with pytest.raises(Exception, match="TaskResourceProfiles"):
        generation.generated(prompts(spark), batch_sensitive, profile=profile).collect()


def test_generation_must_answer_every_prompt(spark):
    with pytest.raises(Exception, match="prompts gave"):
        generation.generated(prompts(spark), lambda: lambda batch: batch[:-1]).collect()


def test_early_stop_is_three_batches(spark):
    assert generation.early_rows(prompts(spark), 4).count() == 12
    assert generation.early_rows(prompts(spark, 7), 4).count() == 7


def test_pairing_is_by_key(spark):
    left = spark.createDataFrame([(i, f"p{i}") for i in range(9)], "idx long, prediction string")
    right = spark.createDataFrame([(i, f"r{i}") for i in reversed(range(9))], "idx long, reference string")
    for r in generation.paired(left, right).collect():
        assert (r.prediction, r.reference) == (f"p{r.pair_id}", f"r{r.pair_id}")


def report_rows(spark, n=12):
    return spark.range(n).select(
        F.col("id").alias("idx"), *[F.concat(F.lit(c[0]), "id").alias(c) for c in ("prompt", "reference", "prediction")]
    )


def test_predictions_file_is_in_order(spark, tmp_path):
    path = sinks.write_predictions(report_rows(spark), str(tmp_path / "p"))
    text = "".join(f.read_text() for f in sorted((tmp_path / "p").glob("part-*")))
    want = "".join(f"Example {i + 1}\nPrediction: p{i}\nReference: r{i}\n{'-' * 40}\n" for i in range(12))
    assert path and text == want


def test_example_report(spark, tmp_path):
    sinks.write_examples(report_rows(spark), str(tmp_path / "e"), num_examples=2)
    (part,) = (tmp_path / "e").glob("part-*")
    block = "\n--- Example {n} ---\nPrompt: p{i}\nReference (Chosen): r{i}\nModel Prediction: p{i}\n" + "-" * 30 + "\n"
    want = "--- Examples (Prediction vs. Reference) ---\n" + block.format(n=1, i=0) + block.format(n=2, i=1)
    assert part.read_text() == want


def test_evaluation_document(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"a b c {i}", f"a b c {i}") for i in range(6)], SCORED_PAIR)
    metrics = evaluation.corpus_metrics(rows)
    path = sinks.write_evaluation(
        metrics, rows, str(tmp_path / "doc"), {"name": "n", "split": "s"}, {"id": "m", "device": "cpu"}, 60
    )
    (part,) = (tmp_path / "doc" / "document").glob("part-*.json")
    document = json.loads(part.read_text())
    assert document["dataset_info"] == {"name": "n", "split": "s", "size": 60, "evaluated": 6}
    assert document["model_info"] == {"id": "m", "device": "cpu"}
    assert document["metrics"]["bleu"]["precisions"] == [1.0] * 4 and document["metrics"]["bleu"]["bleu"] == 1
    assert document["metrics"]["rouge"] == {"rouge1": 1.0, "rouge2": 1.0, "rougeL": 1.0, "rougeLsum": 1.0}
    assert spark.read.json(f"{path}/pairs").count() == 6


def test_triples_join_by_key(spark):
    rows = report_rows(spark)
    got = reports.triples(rows, rows, rows, 4).orderBy("idx").collect()
    assert [(r.prompt, r.reference, r.prediction) for r in got] == [(f"p{i}", f"r{i}", f"p{i}") for i in range(4)]


def test_split_scan_reads_one_partition(spark, tmp_path):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "idx long, split string")
    path = tables.save_splits(df, str(tmp_path / "t"))
    part = tables.scan(spark, path, "a")
    assert sorted(r.idx for r in part.collect()) == [0, 2] and tables.scan(spark, path).count() == 3
    assert len(part.inputFiles()) >= 1
    assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_proven_small(spark):
    small = spark.createDataFrame([("a", 1)], "token string, id long")
    assert session.is_small(small) and session.is_small(small.limit(0))
    assert not session.is_small(spark.range(50).toDF("id"), max_rows=49)
    wide = spark.createDataFrame([("x" * 1000, 1)], "token string, id long")
    assert not session.is_small(wide, max_bytes=900)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_spread_lookup_equals_a_plain_join(spark, monkeypatch, how):
    rows = spark.range(300).select(F.col("id").alias("place"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    table_ = spark.createDataFrame([(7, "hot"), (9, "nine")], "k long, v string")
    want = sorted(rows.join(table_, "k", how).select("place").collect())
    monkeypatch.setattr(session, "is_small", lambda df: False)
    got = session.lookup(rows, table_, ["k"], "place", how)
    assert sorted(got.select("place").collect()) == want
    assert "_way" in got._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_few(spark):
    counted = spark.createDataFrame([(k, 10) for k in range(500)] + [(999, 5000)], "k long, rows long")
    assert [r.k for r in session.hot_keys(counted, share=100).collect()] == [999]


def test_encoding_without_a_broadcast(texts, words, monkeypatch):
    monkeypatch.setattr(session, "is_small", lambda df: False)
    coded = vocab.encode(texts, words, ["text"])
    assert {r.idx: r.text_ids for r in coded.collect()} == {0: [3, 2, 2, 1], 1: [], 2: [2, 3, 0, 0], 5: [1] * 7}
    plain = vocab.decode(coded, words, "text_ids")
    assert {r.idx: r.text for r in plain.collect()}[2] == "a b <unk> <unk>"


def test_encoding_takes_many_chunks_and_no_broadcast(spark, texts, words, monkeypatch):
    """Token rows were shuffled and regrouped, and a vocabulary of up to 64 MB went through the driver."""
    monkeypatch.setattr(vocab, "CHUNK_BYTES", 1)
    coded = vocab.encode(texts, words, ["text"])
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "ResolvedHint" not in coded._jdf.queryExecution().analyzed().toString() and "collect_list" not in plan
    assert {r.idx: r.text_ids for r in coded.collect()} == {0: [3, 2, 2, 1], 1: [], 2: [2, 3, 0, 0], 5: [1] * 7}
    plain = vocab.decode(coded, words, "text_ids")
    assert {r.idx: r.text for r in plain.collect()} == {0: "b a a c", 1: "", 2: "a b <unk> <unk>", 5: "c c c c c c c"}


def test_rows_with_one_key_share_their_tokens(spark, words):
    rows = [(1, "a b"), (1, "c"), (None, "a"), (2, None), (3, "c zz")]
    coded = vocab.encode(spark.createDataFrame(rows, "idx long, text string"), words, ["text"])
    assert sorted((r.idx or 0, r.text or "", r.text_ids) for r in coded.collect()) == [
        (0, "a", []), (1, "a b", [1, 2, 3]), (1, "c", [1, 2, 3]), (2, "", []), (3, "c zz", [1, 0]),
    ]


def fake_session(master, **settings):
    context = SimpleNamespace(master=master, applicationId="app-1")
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_shared_folder_comes_from_the_session():
    named = {"spark.checkpoint.dir": "/shared/folder/"}
    assert session.new_path(fake_session("spark://x", **named), "t").startswith("/shared/folder/t-")
    assert session.shared_dir(fake_session("local[2]")) == session.shared_dir(fake_session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake_session("spark://x"))


def batches_of_events(spark, tmp_path):
    """The events table as several files, so that a stream takes several micro-batches."""
    events = table(spark, "/root/testdata/sf0.001", "events")
    events.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2)
    return events, trainer_raw(stream.parquet(str(tmp_path / "in")))


def test_live_log_equals_static_log(spark, tmp_path):
    events, stream = batches_of_events(spark, tmp_path)
    live.start_log(stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    stored = spark.read.text(str(tmp_path / "out"))
    static = records.normalised(trainer_raw(events))
    from tunetables.sources.runlogs import log_lines

    assert sorted((r.run_id, r.value) for r in stored.collect()) == sorted(
        (r.run_id, r.value) for r in log_lines(static).collect()
    )


def test_what_many_micro_batches_store_is_bounded(spark, tmp_path):
    path, every, newest = str(tmp_path / "summaries"), 4, {}
    for batch in range(42):
        # run 1 always, run 2 once at first, the others in turn
        rows = [(run, batch, 0.5) for run in {1, 3 + batch % 7} | ({2} if batch == 3 else set())]
        newest |= {run: step for run, step, _ in rows}
        changed = spark.createDataFrame(rows, "run_id long, last_step long, best_eval_loss double").coalesce(1)
        live.store_changes(changed, path, batch, every)
        if batch in (7, 18):
            # a repeated micro-batch
            live.store_changes(changed, path, batch, every)
        if batch in (0, 3, 4, 12, 27, 41):
            got = {r.run_id: r.last_step for r in live.current_summaries(spark, path).collect()}
            assert got == newest
    assert len(list((tmp_path / "summaries").iterdir())) == 2 * every + 2
    # two bases, and what eight micro-batches changed
    assert spark.read.parquet(path).count() <= 2 * 9 + 2 * every * 3


def test_live_summary_equals_static_summary(spark, tmp_path):
    events, stream = batches_of_events(spark, tmp_path)
    live.start_summary(stream, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) >= 3
    got = live.current_summaries(spark, str(tmp_path / "out"))
    want = live.running_summary(trainer_raw(events))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
