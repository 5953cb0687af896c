"""Removal of byte strings that occur twice, by suffix arrays over anchored contexts."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.llm.common import mixed
from tunetables.llm.suffix import common_prefixes, gram_hashes, suffix_array
from tunetables.session import lookup, written

#: Length of a string that must not occur twice, and of the anchor within it.
LENGTH = 400
ANCHOR = 128
#: Bytes of a shard about, and contexts of one anchor in a shard at most about.
SHARD = 512 << 10
CONTEXTS = 512
#: Bytes looked at in one call: longer texts go in pieces that overlap by less than one string.
PIECE = 1 << 20
_PLACE = 22


def _key() -> Column:
    """Tells rows apart; rows of one id and text have the same strings and the same key."""
    return F.xxhash64("doc_id", "text")


def _least_places(ranks: np.ndarray, window: int) -> np.ndarray:
    """For each start the place of the least rank among the ``window`` ranks from it on; the first of equals."""
    keyed = (mixed(ranks) >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(ranks), dtype=np.uint64)
    size = 1
    while size * 2 <= window:
        keyed = np.minimum(keyed[:-size], keyed[size:])
        size *= 2
    rest = window - size
    if rest:
        keyed = np.minimum(keyed[:-rest], keyed[rest:])
    return (keyed & np.uint64((1 << _PLACE) - 1)).astype(np.int64)


def anchored(pieces: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Contexts of some texts: number of the text, first byte, size, hash of the anchor, digest.

    Every string of ``length`` bytes has one anchor, the least ranked of its runs of ``anchor``
    bytes, so equal strings have equal anchors at the same place.  A context holds all strings of
    one text whose anchor is at one place, so a string is in one context only.
    """
    from xxhash import xxh3_64_intdigest

    none = np.zeros(0, np.int64)
    joined = b"".join(pieces)
    if len(joined) < length:
        return none, none, none, none, none
    lengths = np.array([len(b) for b in pieces])
    ends = np.cumsum(lengths)
    grams = gram_hashes(np.frombuffer(joined, np.uint8), anchor)
    places = _least_places(grams, length - anchor + 1)
    owner = np.repeat(np.arange(len(pieces)), lengths)[: len(places)]
    at = np.flatnonzero(np.arange(len(places)) + length <= ends[owner])
    if not len(at):
        return none, none, none, none, none
    place, text = places[at], owner[at]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    lo, hi = at[first], at[np.append(first[1:], len(at)) - 1] + length
    digests = np.fromiter((xxh3_64_intdigest(joined[a:b]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)), np.uint64, len(lo))
    own = text[first]
    return own, lo - (ends - lengths)[own], hi - lo, grams[place[first]].view(np.int64), digests.view(np.int64)


def contexts(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """``key`` (of the row) and ``lo, size, anchor, digest`` of each context."""

    def found(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(held: list[tuple[int, int, bytes]]) -> pd.DataFrame:
            own, lo, size, anchors, digests = anchored([h[2] for h in held], length, anchor)
            keys, offsets = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int64)
            return pd.DataFrame({"key": keys[own], "lo": lo + offsets[own], "size": size, "anchor": anchors, "digest": digests})

        for part in parts:
            held: list[tuple[int, int, bytes]] = []
            total = 0
            for key, text in zip(part["key"].tolist(), part["text"], strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for start in range(0, len(data) - length + 1, PIECE - length + 1):
                    held.append((key, start, data[start : start + PIECE]))
                    total += len(held[-1][2])
                    if total >= PIECE // 2:
                        yield out(held)
                        held, total = [], 0
            if held:
                yield out(held)

    rows = docs.where(F.octet_length("text") >= length).select(_key().alias("key"), "text")
    return rows.mapInPandas(found, "key long, lo long, size long, anchor long, digest long")


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges that strings from these ascending places cover."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate([[0], cuts + 1])].tolist(), (starts[np.append(cuts, len(starts) - 1)] + length).tolist(), strict=True))


_MARKS = "key long, a long, b long, anchor long, range int, sub int, prints binary, digest long"


def _marks(rows: list[tuple]) -> pd.DataFrame:
    names = {"key": "Int64", "a": "Int64", "b": "Int64", "anchor": "Int64", "range": "Int32", "sub": "Int32", "prints": "object", "digest": "Int64"}
    # column by column: a frame of rows would turn integers beside nulls into doubles
    return pd.DataFrame({c: pd.array([r[k] for r in rows], dtype=kind) for k, (c, kind) in enumerate(names.items())})


def _sorted_shard(length: int):
    """Of one shard: ranges that are repeated within it, and the strings of anchors that other shards have too."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        blobs = group["bytes"].tolist()
        sizes = np.array([len(b) for b in blobs])
        data = np.frombuffer(b"".join(blobs), np.uint8)
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(blobs)), sizes)
        string = np.arange(len(data)) + length <= (starts + sizes)[owner]
        order = suffix_array(data, length)
        prefixes = common_prefixes(data, order, length)
        # suffixes that share a whole string stand together; those that aren't strings of a text don't count
        together = np.cumsum(prefixes < length) - 1
        times = np.minimum(group["c"].to_numpy(), 2)[owner] * string
        often = np.bincount(together, weights=times[order])[together] > 1
        repeated = np.zeros(len(data), bool)
        repeated[order] = often
        repeated &= string
        out = []
        columns = (group[c].tolist() for c in ("key", "lo", "c", "anchor", "digest"))
        for k, (key, lo, c, anchor, digest) in enumerate(zip(*columns, strict=True)):
            for a, b in _runs(np.flatnonzero(repeated[starts[k] : starts[k] + sizes[k]]), length):
                # what stands for several equal contexts is told to all of them, from their first byte on
                out.append((key, lo + a, lo + b, None, None, None, None, None) if c == 1 else (None, a, b, anchor, None, None, None, digest))
        split = group["parts"].to_numpy() > 1
        if split.any():
            prints = gram_hashes(data, length)
            for anchor in group["anchor"][split].unique().tolist():
                mine = np.flatnonzero((group["anchor"] == anchor).to_numpy())
                parts = int(group["parts"].iloc[mine[0]])
                own = np.unique(prints[np.flatnonzero(string & np.isin(owner, mine))])
                cuts = np.searchsorted(own, np.array([(k << 64) // parts for k in range(1, parts)], np.uint64))
                out += [(None, None, None, anchor, k, int(group["sub"].iloc[0]), x.tobytes(), None) for k, x in enumerate(np.split(own, cuts)) if len(x)]
        return _marks(out)

    return run


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Strings that several shards have, by binary search of each sorted list in all of them."""
    lists = [np.frombuffer(x, np.uint64) for x in group["prints"]]
    every = np.sort(np.concatenate(lists))
    out = []
    for anchor, number, sub, own in zip(group["anchor"].tolist(), group["range"].tolist(), group["sub"].tolist(), lists, strict=True):
        shared = own[np.searchsorted(every, own, "right") - np.searchsorted(every, own, "left") > 1]
        if len(shared):
            out.append((None, None, None, anchor, number, sub, shared.tobytes(), None))
    return _marks(out)


def _marked_shard(length: int):
    """Ranges of a shard's contexts whose strings the merge has found in another shard."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(right):
            shared = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in right["prints"]]))
            for row, lo, c, blob in zip(left["key"].tolist(), left["lo"].tolist(), left["c"].tolist(), left["bytes"], strict=True):
                if c == 1:
                    prints = gram_hashes(np.frombuffer(blob, np.uint8), length)
                    at = np.minimum(np.searchsorted(shared, prints), len(shared) - 1)
                    out += [(row, lo + a, lo + b, None, None, None, None, None) for a, b in _runs(np.flatnonzero(shared[at] == prints), length)]
        return _marks(out)

    return run


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard: int = SHARD, most: int = CONTEXTS) -> DataFrame:
    """``key, a, b``: byte ranges of rows that strings of ``length`` bytes occurring twice cover.

    1. Contexts whose anchor occurs once in the corpus can hold nothing repeated and go.
    2. Equal contexts of an anchor are counted before they meet, so copies of a document, equal rows
       included, are one context that weighs as many as there are.
    3. The different contexts of an anchor go to one shard, at most about ``most`` of them: a
       passage in a third of all documents is split over as many shards as it needs.  A shard sorts
       its suffixes (``suffix_array``); neighbours whose common prefix (``common_prefixes``) is a
       whole string are repeated, and so is a string whose context weighs two or more.  What is found
       in such a context holds for each that it stands for.
    4. Strings of an anchor that was split are merged across its shards: each shard's sorted list
       is searched in the lists of the others, a range of hashes at a time.
    """
    rows = written(contexts(docs, length, anchor), "dup-contexts")
    # stored apart from the joins, which may then split the rows of a hot anchor
    twice = written(rows.groupBy("anchor").agg(F.count("*").alias("_n")).where("_n > 1").select("anchor"), "dup-anchors")
    live = written(rows.join(twice, "anchor", "left_semi"), "dup-live")
    kinds = live.groupBy("anchor", "digest").agg(F.count("*").alias("c"), F.min(F.struct("key", "lo", "size")).alias("r"))
    kinds = written(kinds.select("anchor", "digest", "c", "r.*"), "dup-kinds")
    crowded = written(kinds.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > most), "dup-crowded")

    total = kinds.agg(F.sum("size")).first()[0] or 0
    parts = F.coalesce(F.ceil(F.col("n") / most), F.lit(1)).cast("int")
    several = lookup(kinds, crowded, ["anchor"], spread="digest").withColumns({"parts": parts, "shard": F.pmod(F.xxhash64("anchor"), F.lit(max(1, ceil(total / shard)))).cast("int")})
    several = several.withColumn("sub", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
    wanted = several.groupBy("key").agg(F.collect_list(F.struct("shard", "sub", "parts", "anchor", "digest", "c", "lo", "size")).alias("own"))
    texts = docs.where(F.octet_length("text") >= length).select(_key().alias("key"), F.col("text").cast("binary").alias("text"))
    # equal rows have one key and are cut once
    one = texts.join(wanted, "key").groupBy("key").agg(F.first("text").alias("text"), F.first("own").alias("own"))
    cut = one.select("key", "text", F.explode("own").alias("o"))
    cut = cut.select("key", "o.*", F.substring("text", F.col("o.lo").cast("int") + 1, F.col("o.size").cast("int")).alias("bytes"))
    cut = written(cut, "dup-shards")

    first = written(cut.groupBy("shard", "sub").applyInPandas(_sorted_shard(length), _MARKS), "dup-marks")
    lists = first.where("prints IS NOT NULL")
    found = lists.groupBy("anchor", "range").applyInPandas(_merged, _MARKS)
    split = cut.where("parts > 1")
    second = split.groupBy("anchor", "sub").cogroup(found.groupBy("anchor", "sub")).applyInPandas(_marked_shard(length), _MARKS)
    marks = first.where("key IS NOT NULL").select("key", "a", "b").unionByName(second.select("key", "a", "b"))
    copies = first.where("digest IS NOT NULL").select("anchor", "digest", F.col("a").alias("_a"), F.col("b").alias("_b"))
    held = lookup(live.select("key", "lo", "anchor", "digest"), copies, ["anchor", "digest"], spread="key", how="inner")
    return held.select("key", (F.col("lo") + F.col("_a")).alias("a"), (F.col("lo") + F.col("_b")).alias("b")).unionByName(marks)


def cut_documents(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id, n_bytes, spans, kept``: removed byte ranges (maximal) and the remaining bytes.

    Strings are judged on the input; two occurrences may overlap or stand in one document, but
    none crosses documents.  ``kept`` is binary, since a range can begin within a character.  Null
    and empty texts keep no bytes; shorter texts than a string keep all.  Repeated rows are each
    other's copies.  An empty table gives no rows; other columns are not looked at.
    """
    spans = repeated_ranges(docs.select("doc_id", "text"), **options).groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))

    def merged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out: dict[str, list] = {"doc_id": part["doc_id"].tolist(), "n_bytes": [], "spans": [], "kept": []}
            for text, ranges in zip(part["text"], part["ranges"], strict=True):
                data = bytes(text or b"")
                found: list[list[int]] = []
                for x in sorted((x["a"], x["b"]) for x in ([] if ranges is None else ranges)):
                    if found and x[0] <= found[-1][1]:
                        found[-1][1] = max(found[-1][1], x[1])
                    else:
                        found.append(list(x))
                edges = [0, *(e for f in found for e in f), len(data)]
                out["n_bytes"].append(len(data))
                out["spans"].append([{"start": a, "end": b} for a, b in found])
                out["kept"].append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pd.DataFrame(out)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"), _key().alias("key")).join(spans, "key", "left")
    rows = rows.select("doc_id", "text", "ranges").mapInPandas(merged, "doc_id string, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def removal_digest(cut: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of ``cut_documents``."""
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
