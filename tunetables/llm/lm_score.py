"""N-gram scores from a log-frequency Bloom filter that is broadcast in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.llm.common import hashed_words, mixed
from tunetables.session import new_path, removed, written

#: Hash of the end of a text, as a token, and of what stands before its first word.
END = np.uint64(0xE4D0F7E47B19A52D)
START = np.uint64(0x9B1FD9A3C64E2C17)
#: Levels count by powers of this base: level q stands for a count of about BASE ** (q - 1).
BASE = 1.5
#: Membership probes of a level, and bits for each stored (n-gram, level).
PROBES, BITS = 5, 16
#: Words of the longest n-gram.
ORDER = 3
#: Weight of the shorter context against counts of the longer one.
BACKOFF = 2.0
#: N-grams that one task merges, at most about.
MERGED = 2_000_000
#: Bytes of a filter that are broadcast at a time, at most about.
PIECE = 128 << 20
#: Bytes of text that are counted and scored together.
CHUNK = 8 << 20
#: Bits of an n-gram's hash beyond those that number all n-grams: so many that one in a thousand shares its key.
SPARE = 10


def _tokens(texts: Sequence[str | None]) -> list[np.ndarray]:
    return [np.append(words, END) for words in hashed_words(texts)]


def _longer(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Hash of each n-gram with the token after it."""
    with np.errstate(over="ignore"):
        return mixed(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def _grams(flat: np.ndarray, firsts: np.ndarray, order: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the n-grams of 1 to ``order`` words that end at each token, and of the 1 to ``order - 1`` starts before a text.

    ``firsts`` are the places of first tokens; keys are the upper ``bits`` of hashes.
    """
    cut = np.uint64(64 - bits)
    keys, starts = [_longer(np.zeros(1, np.uint64), flat)], [_longer(np.zeros(1, np.uint64), np.array([START]))]
    own, start = flat, np.array([START])
    while len(keys) < order:
        context = np.roll(own, 1)
        context[firsts] = start
        own, start = _longer(context, flat), _longer(start, np.array([START]))
        keys.append(own)
        starts.append(start)
    return [k >> cut for k in keys], np.concatenate(starts[: order - 1] or [np.zeros(0, np.uint64)]) >> cut


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, modulo 5, is 1; a null id is an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _slices(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, int]]:
    """A batch in slices of about ``size`` bytes of text, and their bytes, so only one slice at a time is Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start), int(ends[stop - 1] - before)
        start = stop


def _shard(keys: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Which of ``shards`` equal ranges a key of ``bits`` bits is in."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each distinct key of a sorted array begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Distinct keys, in order."""
    keys = np.sort(keys)
    return keys[_runs(keys)]


def _found(every: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of ``keys`` in ``every``, which holds them all, distinct and in order; both have ``bits`` bits.

    A hash's upper bits tell about where it stands, so a few looks from there on find it, while a
    binary search in millions of keys misses the cache at most of its steps.
    """
    shift = np.uint64(max(0, bits - len(every).bit_length()))
    held = np.bincount((every >> shift).astype(np.int64), minlength=1 << (bits - int(shift)))
    at = (np.cumsum(held) - held)[keys >> shift]
    left = np.flatnonzero(every[at] != keys)
    while len(left):
        at[left] += 1
        left = left[every[at[left]] != keys[left]]
    return at


def _tallied(grams: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and how often each has weight 1, not 0; keys have 63 bits at most and are sorted with their weight."""
    every = np.concatenate([g << np.uint64(1) | w for g, w in zip(grams, weights, strict=True)])
    every.sort()
    ones = np.concatenate([[0], np.cumsum(every & np.uint64(1), dtype=np.int64)])
    every >>= np.uint64(1)
    starts = _runs(every)
    return every[starts], np.diff(ones[np.append(starts, len(every))])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys, sums = keys[order], np.concatenate([[0], np.cumsum(counts[order])])
    starts = _runs(keys)
    return keys[starts], np.diff(sums[np.append(starts, len(keys))])


def _squeezed(x: np.ndarray) -> bytes:
    """Whole numbers, lowest bytes first and the next ones after, each of these rows compressed."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    rows = x.astype("<u8").view("u1").reshape(-1, 8)[:, :width]
    small = [pa.compress(np.ascontiguousarray(rows[:, k]).tobytes(), codec="zstd", asbytes=True) for k in range(width)]
    return np.array([width, *map(len, small)], "<u4").tobytes() + b"".join(small)


def _whole(pack: bytes, n: int) -> np.ndarray:
    """What ``_squeezed`` made of ``n`` numbers, as unsigned 64-bit numbers."""
    out = np.zeros((n, 8), "u1")
    if n:
        width = int(np.frombuffer(pack, "<u4", 1)[0])
        ends = 4 * (width + 1) + np.cumsum([0, *np.frombuffer(pack, "<u4", width, 4).tolist()])
        for k in range(width):
            out[:, k] = np.frombuffer(pa.decompress(pack[ends[k] : ends[k + 1]], decompressed_size=n, codec="zstd", asbytes=True), "u1")
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _gaps(keys: np.ndarray) -> bytes:
    """Sorted keys by the steps between them."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _keys(gaps: bytes, n: int) -> np.ndarray:
    return np.cumsum(_whole(gaps, n), dtype=np.uint64)


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised logarithm of counts: 1 for 1, 3 for 2, 4 for 3, 5 for 5 and so on."""
    return 1 + np.rint(np.log(np.maximum(counts, 1)) / log(BASE)).astype(np.int64)


def estimates(held: np.ndarray) -> np.ndarray:
    """Counts that levels stand for; 0 for level 0."""
    return np.where(held > 0, BASE ** (held.astype(np.float64) - 1), 0)


@dataclass
class LogFrequencyBloom:
    """Membership of (n-gram, level): an n-gram of level q is stored with every level up to q.

    The probes of one entry are bits of one 64-bit word, so a test is one look into memory.
    """

    words: np.ndarray

    @staticmethod
    def empty(entries: int) -> LogFrequencyBloom:
        return LogFrequencyBloom(np.zeros(max(8, -(-entries * BITS // 64)), np.uint64))

    def _places(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Word and mask of each entry."""
        with np.errstate(over="ignore"):
            h = mixed(keys + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64)))
            mask = np.zeros(len(keys), np.uint64)
            for k in range(PROBES):
                mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
            return ((h >> np.uint64(32)) * np.uint64(len(self.words)) >> np.uint64(32)).astype(np.int64), mask

    def add(self, keys: np.ndarray, top: np.ndarray) -> None:
        """Stores keys of the given levels."""
        level = 1
        while len(keys):
            at, mask = self._places(keys, level)
            np.bitwise_or.at(self.words, at, mask)
            level += 1
            keys, top = keys[top >= level], top[top >= level]

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        at, mask = self._places(keys, level)
        return self.words[at] & mask == mask

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Levels are probed from the first up until one is missing."""
        out, alive, level = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        while len(alive):
            alive = alive[self.has(keys[alive], level)]
            out[alive] = level
            level += 1
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts."""
        return estimates(self.level(keys))


CHUNKS = "chunk long, n long, rows binary, words binary, codes binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """``chunk, n, rows, words, codes``: rows that are counted and scored together.

    ``rows`` holds ids and numbers of tokens as a compressed Arrow stream, ``words`` the distinct
    hashes of the ``n`` tokens, frequent ones first, ``codes`` each token's place in them.  Ids go
    through Python as text, which keeps nulls and large ids.
    """

    def packs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId() << 33, 0
        rows: list[pa.RecordBatch] = []
        tokens: list[np.ndarray] = []
        size = 0

        def pack() -> pa.RecordBatch:
            table = pa.Table.from_batches(rows).append_column("n_tokens", pa.array([len(t) for t in tokens], "int64"))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table)
            flat = np.concatenate(tokens)
            words, codes, counts = np.unique(flat, return_inverse=True, return_counts=True)
            often = np.argsort(-counts, kind="stable")
            place = np.empty_like(often)
            place[often] = np.arange(len(often))
            values = [first + number], [len(flat)], [sink.getvalue().to_pybytes()], [words[often].tobytes()], [_squeezed(place[codes])]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, ("int64", "int64", "binary", "binary", "binary"), strict=True)], ["chunk", "n", "rows", "words", "codes"])

        for whole in parts:
            for part, own in _slices(whole):
                rows.append(part.select(["doc_id", "held_out"]))
                tokens += _tokens(part.column("text").to_pylist())
                size += own
                if size >= CHUNK:
                    yield pack()
                    rows, tokens, size, number = [], [], 0, number + 1
        if rows:
            yield pack()

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return texts.mapInArrow(packs, CHUNKS)


def _unpacked(n: int, rows: bytes, words: bytes, codes: bytes) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's rows, distinct words, each token's place in them, and the places of first tokens."""
    frame = pa.ipc.open_stream(rows).read_all().to_pandas()
    return frame, np.frombuffer(words, np.uint64), _whole(codes, n).astype(np.int64), np.cumsum(frame["n_tokens"]).to_numpy() - frame["n_tokens"].to_numpy()


ASKS = "shard int, chunk long, n int, gaps binary, counts binary"


def _asks(chunks: DataFrame, shards: int, bits: int, asked) -> DataFrame:
    """``shard, chunk, n, gaps, counts``: a chunk's distinct keys and their counts in its training rows, by range.

    ``asked`` gives them for an unpacked chunk.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                [chunk] = part.slice(k, 1).to_pylist()
                keys, counts = asked(*_unpacked(*(chunk.pop(c) for c in ("n", "rows", "words", "codes"))))
                place = _shard(keys, shards, bits)
                first = _runs(place)
                own = place[first]
                split = list(zip(np.split(keys, first[1:]), np.split(counts, first[1:]), strict=True))
                columns = {
                    "shard": pa.array(own, "int32"),
                    "chunk": pa.array([chunk["chunk"]] * len(own), "int64"),
                    "n": pa.array([len(k) for k, _ in split], "int32"),
                    "gaps": pa.array([_gaps(k) for k, _ in split], "binary"),
                    "counts": pa.array([_squeezed(c) for _, c in split], "binary"),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return chunks.mapInArrow(run, ASKS)


def _training(rows: pd.DataFrame) -> np.ndarray:
    """1 for each token of a training row, 0 for others."""
    return np.repeat(~rows["held_out"].to_numpy(bool), rows["n_tokens"]).astype(np.uint64)


def _ngrams(order: int, bits: int):
    """What a chunk asks of the filter: its distinct n-grams of all orders, and the starts of its texts."""

    def asked(rows: pd.DataFrame, words: np.ndarray, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grams, starts = _grams(words[codes], firsts, order, bits)
        # each start stands once before every text
        each = (~rows["held_out"].to_numpy(bool)).astype(np.uint64)
        return _tallied([*grams, np.repeat(starts, len(each))], [_training(rows)] * order + [np.tile(each, len(starts))])

    return asked


def _words(rows: pd.DataFrame, words: np.ndarray, codes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's distinct words, in order of their hash, and their counts."""
    order = np.argsort(words)
    return words[order], np.bincount(codes, _training(rows), len(words)).astype(np.int64)[order]


def _merged(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All distinct keys of a shard, and their counts."""
    keys = [_keys(g, n) for g, n in zip(group["gaps"], group["n"], strict=True)]
    counts = [_whole(c, n).astype(np.int64) for c, n in zip(group["counts"], group["n"], strict=True)]
    return _summed(np.concatenate(keys), np.concatenate(counts))


def _filters(asks: DataFrame, shards: int) -> DataFrame:
    """``shard, bits``: the part of the filter for each range of the hash."""

    def made(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(group)
        keys, top = keys[counts > 0], levels(counts[counts > 0])
        bloom = LogFrequencyBloom.empty(int(top.sum()))
        bloom.add(keys, top)
        return pd.DataFrame({"shard": [key[0]], "bits": [bloom.words.tobytes()]})

    return asks.repartition(shards, "shard").groupBy("shard").applyInPandas(made, "shard int, bits binary")


def _exact(asks: DataFrame, shards: int) -> DataFrame:
    """``shard, chunk, size, found, n, total``: exact counts of the words of each chunk; the row of chunk -1 is the shard's own."""

    def answered(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(group)
        found = [_squeezed(counts[np.searchsorted(keys, _keys(g, n))]) for g, n in zip(group["gaps"], group["n"], strict=True)]
        out = pd.DataFrame({"shard": key[0], "chunk": [*group["chunk"], -1], "size": [*group["n"], 0], "found": [*found, None]})
        return out.assign(n=int((counts > 0).sum()), total=int(counts.sum()))

    return asks.repartition(shards, "shard").groupBy("shard").applyInPandas(answered, "shard int, chunk long, size int, found binary, n long, total long")


def _probed(spark: SparkSession, stored: str, shards: int, pieces: int) -> DataFrame:
    """``shard, chunk, size, found``: the level of each n-gram that a chunk holds.

    The filter is made and broadcast piece by piece, and a piece is asked only by the n-grams of
    its own range, which stand in a folder of their own under ``stored``.  Once all its levels are
    stored, nothing reads that folder any more, and it is removed.
    """
    path = new_path(spark, "lm-levels")
    schema = "shard int, chunk long, size int, found binary"
    spark.createDataFrame([], schema).write.parquet(f"{path}/piece=-1")
    for piece in range(pieces):
        # by the whole folder, which is there when a piece has no rows; only the piece's own files are read
        mine = spark.read.schema(f"{ASKS}, piece int").parquet(stored).where(F.col("piece") == piece)
        # the piece's n-grams, at 1.5 levels each at most, bound what is collected and sent
        shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["bits"]) for r in _filters(mine, -(-shards // pieces)).collect()})

        def probed(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            blooms = {k: LogFrequencyBloom(np.frombuffer(words, np.uint64)) for k, words in shared.value.items()}
            for part in parts:
                shard, chunk, n = (part.column(c).to_pylist() for c in ("shard", "chunk", "n"))
                found = [_squeezed(blooms[s].level(_keys(g.as_py(), k))) for s, k, g in zip(shard, n, part.column("gaps"), strict=True)]
                yield pa.RecordBatch.from_pydict({"shard": pa.array(shard, "int32"), "chunk": pa.array(chunk, "int64"), "size": pa.array(n, "int32"), "found": pa.array(found, "binary")})

        mine.select("shard", "chunk", "n", "gaps").mapInArrow(probed, schema).write.parquet(f"{path}/piece={piece}")
        shared.destroy()
        removed(spark, f"{stored}/piece={piece}")
    return spark.read.schema(schema).parquet(path)


RESULT = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def lm_scores(docs: DataFrame, order: int = ORDER, merged: int = MERGED, piece_bytes: int = PIECE) -> DataFrame:
    """Per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``score`` is the sum over tokens of log10 of P_order, where P_1(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))
    and P_k(w | h) = (c(hw) + 2 P_k-1(w | shorter h)) / (c(h) + 2).  Every c is what the log-frequency
    Bloom filter of all n-grams answers when it is probed level by level: a power of 1.5, within a
    factor of 1.23 of the count; an n-gram is never held to be more frequent than the shorter ones
    that it starts and ends with.  So the P of all words after a context add up to between 1/1.5 and
    1.5, beside the false positives (16 bits and 5 probes: under 1 % of absent n-grams count as
    one).  N, V, ``n_known`` and ``base_score`` are of exact counts, which the score does not use.

    The filter grows with the corpus.  It is built by ranges of the hash, and its ranges are broadcast
    ``piece_bytes`` at a time, in one pass each over the n-grams of that range; so the work grows as
    the input, with a job for each piece.  A word of every text is one n-gram of each chunk.

    Null, empty and blank texts have the end token only.  A very long text is a chunk of its own.  A
    null id counts as an empty id text and is in training.  Repeated rows are counted and scored
    each.  With no training rows nothing is known; an empty table gives no row.  Columns of other
    names are not looked at.
    """
    spark = docs.sparkSession
    chunks = written(_chunks(docs), "lm-chunks")
    size = chunks.agg(F.count("*").alias("chunks"), F.sum("n").alias("tokens")).first()
    ngrams = (size["tokens"] or 0) * order
    bits = max(32, ngrams.bit_length() + SPARE)
    shards = max(1, ceil(ngrams / merged))
    # a count of c is in 1 + log(c) / log(1.5) levels, 1.5 * c at most
    pieces = min(shards, max(1, ceil(1.5 * ngrams * BITS / 8 / piece_bytes)))
    path = new_path(spark, "lm-asks")
    asks = _asks(chunks, shards, bits, _ngrams(order, bits)).withColumn("piece", F.expr(f"int(shard * {pieces}L div {shards}L)"))
    asks.write.partitionBy("piece").parquet(path)
    probed = _probed(spark, path, shards, pieces)
    exact = written(_exact(_asks(chunks, shards, 64, _words), shards), "lm-words")
    sums = exact.where("chunk = -1").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    total, distinct = sums["total"] or 0, sums["n"] or 0

    def scored(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows, words, codes, firsts = _unpacked(*left[["n", "rows", "words", "codes"]].iloc[0])
        right = right.sort_values("shard")
        found = {k: np.concatenate([_whole(x, n) for x, n in zip(own["found"], own["size"], strict=True)]).astype(np.int64) for k, own in right.groupby("exact")}
        exactly = np.empty(len(words), np.int64)
        exactly[np.argsort(words)] = found[True]
        counts = exactly[codes]
        keys, starts = _grams(words[codes], firsts, order, bits)
        every = np.concatenate([*keys, starts])
        *held, started = np.split(estimates(found[False])[_found(_distinct(every), every, bits)], np.cumsum([len(k) for k in keys]))
        base = (counts + 0.5) / (total + 0.5 * (distinct + 1))
        least = held[0]
        shares = (least + 0.5) / (total + 0.5 * (distinct + 1))
        for own, start in zip(held[1:], started, strict=True):
            context = np.roll(least, 1)
            context[firsts] = start
            least = np.minimum(np.minimum(own, context), least)
            shares = (least + BACKOFF * shares) / (context + BACKOFF)
        add = lambda x: np.add.reduceat(x, firsts)
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].tolist(),
                "held_out": rows["held_out"].tolist(),
                "n_tokens": rows["n_tokens"].tolist(),
                "n_known": add((counts > 0).astype(np.int64)),
                "train_tokens": total,
                "base_score": add(np.log10(base)),
                "score": add(np.log10(shares)),
            }
        )

    told = exact.where("chunk >= 0").select("chunk", "shard", "size", "found", F.lit(True).alias("exact"))
    told = told.unionByName(probed.select("chunk", "shard", "size", "found", F.lit(False).alias("exact")))
    tasks = max(1, ceil(size["chunks"] / 4))
    joined = chunks.repartition(tasks, "chunk").groupBy("chunk").cogroup(told.repartition(tasks, "chunk").groupBy("chunk")).applyInPandas(scored, RESULT)
    return joined.withColumn("doc_id", F.col("doc_id").cast("long"))
