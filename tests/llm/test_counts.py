"""Token counts, token files and mixes against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import documents, with_clashes
from tokenizers import Tokenizer

from tunetables.llm import mixing, token_counts, token_files
from tunetables.llm.encoding import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None,
    "",
    "   \n\t ",
    "Hello, World! it's  fine\r\nyes",
    "x<|endoftext|>y <|startoftext|>",
    "a b　c ́e é ΑΣ ΑΣ\x1cz\x85q",
    "<|endoftext|>",
    "日本語 テキスト 😀👍🏽",
    "word " * 3000 + "z" * 5000,
    "Hello, World! it's  fine\r\nyes",
]


@pytest.fixture(scope="module")
def wanted():
    plain = Tokenizer.from_file(PATH)
    return [plain.encode(t or "", add_special_tokens=False).ids for t in ODD]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_tokenizer(name):
    plain, own = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name))
    for _ in range(2):
        got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode(ODD)]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in ODD]


def test_length_table(spark, wanted):
    docs = with_clashes(documents(spark, list(enumerate(ODD))))
    lengths = [len(x) for x in wanted]
    table = token_counts.length_table(docs, PATH)
    got = {r["n_tokens"]: r for r in table.collect()}
    assert {k: r["documents"] for k, r in got.items()} == Counter(lengths)
    for k, r in got.items():
        assert r["documents_from"] == sum(x >= k for x in lengths)
        assert r["tokens_from"] == sum(x for x in lengths if x >= k)
        assert r["tokens_cut"] == sum(min(x, k) for x in lengths)
        assert r["share_below"] == sum(x < k for x in lengths) / len(lengths)
    shares = [0.1, 0.5, 0.95, 1.0]
    found = {r["share"]: r["n_tokens"] for r in token_counts.quantiles(table, shares).collect()}
    assert found == {s: sorted(lengths)[max(0, -(-int(s * 1000) * len(lengths) // 1000) - 1)] for s in shares}
    cuts = {r["max_tokens"]: tuple(r)[1:] for r in token_counts.cut_totals(table, [1, 5, 10**6]).collect()}
    assert cuts == {m: (sum(min(x, m) for x in lengths), sum(x > m for x in lengths)) for m in (1, 5, 10**6)}
    assert token_counts.length_table(docs.limit(0), PATH).collect() == []


def test_suffix_sums_over_many_ranges(spark):
    rng = random.Random(3)
    counts = {rng.randrange(40_000): rng.randrange(1, 9) for _ in range(300)}
    table = token_counts.suffix_sums(spark.createDataFrame(list(counts.items()), "n_tokens long, documents long"))
    for r in table.collect():
        assert r["tokens_cut"] == sum(min(k, r["n_tokens"]) * n for k, n in counts.items())
        assert r["documents_from"] == sum(n for k, n in counts.items() if k >= r["n_tokens"])


@pytest.mark.parametrize("length", [4, 2048])
def test_token_files_round_trip(spark, wanted, length, tmp_path):
    rows = [(6 - i if i < 7 else None if i == 8 else i, t) for i, t in enumerate(ODD)]
    docs = with_clashes(documents(spark, rows)).repartition(5)
    index = token_files.write_token_files(docs, PATH, folder=str(tmp_path / "files"), length=length)
    got = [tuple(r) for r in token_files.read_token_files(index).collect()]
    ids = {}
    for (doc_id, _), x in zip(rows, wanted, strict=True):
        ids[doc_id] = [*x, 1]
    start = 0
    for doc_id in sorted(ids, key=lambda x: (x is not None, x)):
        x = np.array(ids[doc_id], "<u4")
        assert (doc_id, start, len(x), zlib.crc32(x.tobytes())) in got
        start += len(x)
    assert len(got) == len(rows)
    [name] = {r["file"] for r in index.collect()}
    file = token_files.SequenceFile(name)
    line, real = zip(*[file.sequence(i) for i in range(-(-start // length))], strict=True)
    line, real = np.concatenate(line), np.concatenate(real)
    assert real.sum() == start and real[:start].all() and not line[start:].any()
    assert token_files.token_files(docs.limit(0), PATH).collect() == []


def test_token_files_of_repeated_ids_over_several_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 400)
    rows = [(i // 3, f"text number {i // 2} " * 5) for i in range(60)]
    index = token_files.write_token_files(documents(spark, rows), PATH)
    assert len({r["file"] for r in index.collect()}) > 3
    got = sorted(token_files.read_token_files(index).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows)
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]


def brute_targets(sizes: dict, weights=(5, 2, 1)):
    total, left = 1.5 * sum(sizes.values()), dict(sizes)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target = {}
    while left:
        share = (total - sum(target.values())) / sum(weight[s] for s in left)
        over = [s for s in left if share * weight[s] > 2 * sizes[s]]
        for s in over or list(left):
            target[s] = 2.0 * sizes[s] if over else share * weight[s]
            del left[s]
    return target


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([0, 3, 50, 200])), rng.choice(["b", "a", "a", "a", "é", None, ""])) for i in range(3000)]
    rows += [(3000, None, "a"), (3001, "x y \x1c z\x0b", "b"), (3002, "tiny one", "z"), (3003, "\t\n", "zz")] + rows[:5]
    docs = with_clashes(documents(spark, rows)).drop("size").withColumn("size", F.lit("clash"))
    got = mixing.mix(docs, shard=100).collect()
    again = mixing.mix(docs.repartition(9), shard=100).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len([w for w in (t or "").replace("\n", " ").replace("\t", " ").replace("\x0b", " ").split(" ") if w])) for i, t, *_ in rows)
    source = {r[0]: r[2] for r in rows}
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert target.setdefault(s, r["target"]) == r["target"]
    want = brute_targets(sizes)
    shards = Counter(source.values())
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 32 * 3 * (1 + shards[s] / 100)
    for r in got:
        assert r["source_size"] == sizes[source[r["doc_id"]]]


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, []).limit(0)).collect() == []
    empty = mixing.mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in empty] == [(0, 0.0, 0)] * 2


def test_apportioned_by_highest_quotients(spark):
    rng = random.Random(9)
    groups = {g: [float(rng.choice([0, 1, 7, 7, 300, 12345])) for _ in range(rng.randrange(1, 30))] for g in range(12)}
    seats = {g: rng.randrange(0, 400) if sum(v) else 0 for g, v in groups.items()}
    rows = [(g, k, v, seats[g]) for g, vs in groups.items() for k, v in enumerate(vs)]
    table = spark.createDataFrame(rows, "g long, k long, votes double, m long")
    got = {(r["g"], r["k"]): r["seats"] for r in mixing.apportioned(table, F.col("m"), ["g"], "k").collect()}
    for g, vs in groups.items():
        best = sorted(((-v / (2 * i + 1), k) for k, v in enumerate(vs) for i in range(seats[g] + 1)))[: seats[g]]
        want = defaultdict(int, Counter(k for _, k in best))
        assert [got[g, k] for k in range(len(vs))] == [want[k] for k in range(len(vs))]


def test_mixed_documents_take_whole_rows(spark):
    rows = [(i, "w " * (1 + i % 50), "ab"[i % 2]) for i in range(400)]
    docs = with_clashes(documents(spark, rows))
    takes = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    got = mixing.mixed_documents(docs).collect()
    assert got[0].asDict().keys() == set(docs.columns) and got[0]["size"] == "kept size"
    assert Counter(r["doc_id"] for r in got) == Counter({i: int(r["taken"] / r["size"] + 0.5) for i, r in takes.items() if r["taken"] / r["size"] >= 0.5})
