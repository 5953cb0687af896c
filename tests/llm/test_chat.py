"""Speaker recovery against a plain Viterbi and against the true turns."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tunetables.llm import chat_format as C


def conversations(spark, rng, n):
    rows = []
    for conv in range(n):
        turn = 0
        if rng.random() < 0.3:
            rows.append((conv, 0, "system", "be brief and helpful"))
            turn = 1
        for k in range(rng.randrange(1, 7)):
            text = f"what is {rng.randrange(99)}?" if k % 2 == 0 else "\n".join("it is so " * rng.randrange(1, 30) for _ in range(rng.randrange(1, 4)))
            rows.append((conv, turn + k, "user" if k % 2 == 0 else "assistant", text))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows


def plain_viterbi(model, codes):
    score, back = np.full(C.STATES + 1, -np.inf), []
    score[C.BEFORE] = 0
    for c in codes:
        every = score[:, None] + model.step(c)
        back.append(every.argmax(axis=0))
        score = every.max(axis=0)
    out = [int(score.argmax())]
    for b in back[:0:-1]:
        out.append(int(b[out[-1]]))
    return out[::-1]


def test_chunks_give_the_whole_path(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 4)
    rng = random.Random(1)
    table, _ = conversations(spark, rng, 30)
    lines = C.transcript_lines(table)
    model = C.learned(lines)
    # one long transcript: more than 4 * 4 * 4 lines
    long = [(1000, i, rng.choice(["User: hi?", "A> yes", "more", "", "System: x"])) for i in range(150)]
    extra = lines.drop("state").unionByName(spark.createDataFrame(long, "conv_id long, line_no long, line string"))
    coded = extra.withColumn("code", C.line_code(F.col("line"), F.col("line_no"))).collect()
    got = {(r["conv_id"], r["line_no"]): r["state"] for r in C.decoded(extra, model).collect()}
    assert len(got) == len(coded)
    for conv in {r["conv_id"] for r in coded}:
        codes = [r["code"] for r in sorted((r for r in coded if r["conv_id"] == conv), key=lambda r: r["line_no"])]
        want = plain_viterbi(model, codes)
        step = model.steps()

        def score(path, codes=codes, step=step):
            return sum(step[c][a, b] for c, a, b in zip(codes, [C.BEFORE, *path], path, strict=False))

        path = [got[conv, i] for i in range(len(codes))]
        assert path == want or abs(score(path) - score(want)) < 1e-9


def test_turns_come_back(spark):
    rng = random.Random(3)
    train, _ = conversations(spark, rng, 200)
    model = C.learned(C.transcript_lines(train))
    test, rows = conversations(spark, rng, 100)
    lines = C.transcript_lines(test.withColumn("line", F.lit("clash")))
    states = {(r["conv_id"], r["line_no"]): r["state"] for r in lines.collect()}
    got = C.decoded(lines.drop("state"), model).collect()
    assert np.mean([states[r["conv_id"], r["line_no"]] // 2 == r["state"] // 2 for r in got]) > 0.93
    turns = C.formatted(lines.drop("state"), model).collect()
    want = {(c, r, t.rstrip()) for c, _, r, t in rows}
    found = {(r["conv_id"], r["role"], r["text"]) for r in turns}
    assert len(found & want) > 0.85 * len(want)
    one = next(r for r in turns if (r["conv_id"], r["role"], r["text"]) in want)
    assert one["rendered"] == f"<|{one['role']}|>\n{one['text']}\n<|end|>"


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, ""), (None, 0, "user", "x"), (2, None, "user", "x"), (3, 5, "tool", "a\n\nb"), (3, 5, "tool", "c"), (4, 0, "assistant", "z" * 50_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = C.transcript_lines(table)
    own = sorted((r["conv_id"], r["line_no"]) for r in lines.collect())
    # no row is lost: equal ones follow each other, one without an id is a conversation of its own
    assert own[0][0] < 0 and own[1:] == [(1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1), (3, 2), (3, 3), (4, 0)]
    turns = C.formatted(lines.drop("state"), C.learned(lines)).collect()
    assert {r["conv_id"] for r in turns} == {own[0][0], 1, 2, 3, 4}
    nothing = C.transcript_lines(table.limit(0))
    assert C.formatted(nothing.drop("state"), C.learned(nothing)).collect() == []


def test_many_rows_of_a_turn_keep_their_order(spark):
    rows = [(1, 0, "user", f"{i:05d}\nand more") for i in range(1500)] + [(1, 1, "assistant", "next"), (1, None, "user", "last")] + [(None, 0, "user", "x")] * 3
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("_order", F.lit("clash"))
    lines = C.transcript_lines(table)
    one = [r["line"] for r in lines.where("conv_id = 1").orderBy("line_no").collect()]
    assert [line.split(" ")[-1] for line in one[:-2:2]] == [f"{i:05d}" for i in range(1500)]
    assert one[-2].endswith("next") and one[-1].endswith("last") and len(one) == 3002
    assert lines.where("conv_id < 0").select("conv_id").distinct().count() == 3
