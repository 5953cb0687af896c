"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.llm.common import hashed_words, in_pieces, mixed, n_words, packed, shingle_sets
from tunetables.llm.graph import components
from tunetables.session import is_small, written

SHINGLE = 4
#: Percent of the union that two sets must share.
SIMILAR = 80
#: Rows of a band and bands: a pair at 0.8 meets in none with probability 8e-6, one at 0.3 meets in one of 240 cases.
ROWS, BANDS = 8, 64
#: Length of the permutations, a power of two.
SPACE = 1 << 20
#: Shingles of a block when a bucket is compared within.
BLOCK_SHINGLES = 200_000


class CirculantMinHash:
    """Signatures from two permutations: sigma places an element, pi shifted by k ranks it for coordinate k.

    Coordinate k of a set is the least pi[(sigma(x) + k) mod SPACE] over its elements x, so all
    coordinates of an element are one run of pi.
    """

    def __init__(self, size: int = ROWS * BANDS, seed: int = 29):
        rng = np.random.default_rng(seed)
        self.size = size
        self.sigma = rng.permutation(SPACE).astype(np.int64)
        pi = rng.permutation(SPACE).astype(np.uint32)
        self.runs = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[: size - 1]]), size)

    def signature(self, elements: np.ndarray) -> np.ndarray:
        """Least ranks of a non-empty set of 64-bit hashes."""
        at = self.sigma[(elements & np.uint64(SPACE - 1)).astype(np.int64)]
        least = None
        for a in range(0, len(at), 512):
            part = self.runs[at[a : a + 512]].min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least

    def bands(self, sets: list[np.ndarray]) -> np.ndarray:
        """For each non-empty set a 64-bit hash of each band, which also tells bands apart."""
        ranks = np.stack([self.signature(s) for s in sets]).reshape(len(sets), BANDS, ROWS).astype(np.uint64)
        total = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sets), 1))
        with np.errstate(over="ignore"):
            for k in range(ROWS):
                total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + ranks[:, :, k])
        return total.view(np.int64)


def _class(elements: np.ndarray) -> int:
    """Signed 64-bit hash of a set: documents of one set are one class."""
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(elements.tobytes())).view(np.int64))


def signed_documents(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, key`` (hash of the text), ``n_shingles, cid`` (class; null when empty) and ``bands`` of every row."""

    def signed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker = CirculantMinHash()
        for part in parts:
            ids, own, texts = part["doc_id"].tolist(), part["key"].tolist(), part["text"].tolist()
            for a, b in in_pieces(texts):
                sets = shingle_sets(hashed_words(texts[a:b]), shingle)
                full = [s for s in sets if len(s)]
                bands = iter(maker.bands(full)) if full else iter(())
                yield pd.DataFrame(
                    {
                        "doc_id": ids[a:b],
                        "key": own[a:b],
                        "n_shingles": [len(s) for s in sets],
                        "cid": pd.array([_class(s) if len(s) else None for s in sets], dtype="Int64"),
                        "bands": [next(bands) if len(s) else None for s in sets],
                    }
                )

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    rows = rows.mapInPandas(signed, "doc_id string, key long, n_shingles long, cid long, bands array<long>")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def class_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``cid, elements`` of the wanted classes; ``wanted`` has ``cid, at`` (a row that has the set)."""

    def made(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = part["text"].tolist()
            for a, b in in_pieces(texts):
                sets = [s for s in shingle_sets(hashed_words(texts[a:b]), shingle) if len(s)]
                yield pd.DataFrame({"cid": [_class(s) for s in sets], "elements": [s.view(np.int64) for s in sets]})

    reps = wanted.select(F.col("at.doc_id").alias("_id"), F.col("at.key").alias("_key")).distinct()
    reps = F.broadcast(reps) if is_small(reps) else reps
    rows = docs.select("doc_id", "text").join(reps, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_semi")
    rows = rows.select("text").mapInPandas(made, "cid long, elements array<long>")
    return rows.join(wanted.select("cid"), "cid", "left_semi").groupBy("cid").agg(F.first("elements").alias("elements"))


def _similar(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(F.col(a), F.col(b)))
    return 100 * both >= SIMILAR * (F.size(a) + F.size(b) - both)


def _compared(group: pd.DataFrame) -> pd.DataFrame:
    """Links between different components of one block pair: one for each two that meet."""
    n, component = len(group), group["component"].to_numpy()
    none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    if len(np.unique(component)) < 2:
        return none
    sets = group["elements"].tolist()
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    owner = np.repeat(np.arange(n), sizes)[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    ends = np.cumsum(sizes)
    parent = {int(c): int(c) for c in component}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    out, ids = [], group["cid"].to_numpy()
    for x in range(n):
        own = codes[ends[x] - sizes[x] : ends[x]]
        lengths = starts[own + 1] - starts[own]
        places = np.arange(lengths.sum()) + np.repeat(starts[own] - np.cumsum(lengths) + lengths, lengths)
        shared = np.bincount(owner[places], minlength=n)
        near = (100 * shared >= SIMILAR * (sizes[x] + sizes - shared)) & (component != component[x])
        for y in np.flatnonzero(near):
            a, b = root(int(component[x])), root(int(component[y]))
            if a != b:
                parent[a] = b
                out.append((int(ids[x]), int(ids[y])))
    return pd.DataFrame(out, columns=["a", "b"]) if out else none


def links(members: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Links ``a, b`` that join components of one bucket with each other.

    ``members`` has ``bucket, cid, n``, ``found`` the component of each class so far.  Only buckets
    with several components are looked at: their classes are dealt to blocks of a bounded number
    of shingles, and each pair of blocks is one group that gives at most one link for each class.
    No pair of a bucket is left out, none is a row.
    """
    labelled = members.join(found, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    labelled = written(labelled, "near-members")
    # in a bucket of two the only pair has been checked
    several = labelled.groupBy("bucket").agg(
        F.count("*").alias("_count"),
        F.min("component").alias("_a"),
        F.max("component").alias("_b"),
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"),
    )
    several = several.where("_a < _b AND _count > 2").select("bucket", "blocks")
    rows = labelled.join(several, "bucket").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: (F.col("blocks") == 1) | (k != F.col("block")))
    rows = rows.withColumn("other", F.explode(others))
    rows = rows.select("bucket", "cid", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = rows.join(sets, "cid")
    return rows.groupBy("bucket", "i", "j").applyInPandas(_compared, "a long, b long")


def _least() -> Column:
    """The row that stands for a group: the least id that is not null, and of its texts the one of least hash."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept, cid``.

    1. Documents of one shingle set are one class, whose hash-sum pre-aggregates copies.
    2. Classes that share a band meet in a bucket; each is checked against one class of its bucket
       on their full sets, and components are built from the links that hold.
    3. In buckets that still hold several components, all classes of different components are
       checked on their full sets (``links``), so no link between classes of one bucket is lost.
    Neither the members of a bucket nor pairs of them are gathered beyond a block; links,
    components and sets stay tables in the shared folder.

    Null, empty and blank texts have no shingles and are linked with nothing.  A text of fewer than
    ``shingle`` words is one shingle.  Repeated rows are one class; rows of one id with other texts
    each have their own class.  ``component_id`` is the smallest id that is not null (null if there
    is none, and of an empty text the document's own); a null id is never kept.
    """
    out = _labelled(docs, shingle)
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "cid")


def _labelled(docs: DataFrame, shingle: int) -> DataFrame:
    """Per row: ``doc_id, key, n_shingles, component_id, cid, component`` (a class of it; null when empty)."""
    rows = written(signed_documents(docs, shingle), "near-signed")
    classes = rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), _least().alias("at"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = written(classes, "near-classes")
    spread = classes.select("cid", "n", F.explode("bands").alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.count("*").alias("_count"), F.min("cid").alias("hub")).where("_count > 1")
    members = written(spread.join(buckets.select("bucket", "hub"), "bucket"), "near-buckets")

    wanted = members.select("cid").distinct().join(classes.select("cid", "at"), "cid")
    sets = written(class_sets(docs, wanted, shingle), "near-sets")
    pairs = members.where("hub <> cid").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    one = sets.select(F.col("cid").alias("b"), F.col("elements").alias("_y"))
    two = sets.select(F.col("cid").alias("a"), F.col("elements").alias("_x"))
    stars = written(pairs.join(one, "b").join(two, "a").where(_similar("_x", "_y")).select("a", "b"), "near-links")
    found = components(stars)
    more = written(links(members.select("bucket", "cid", "n"), sets, found), "near-more-links")
    found = components(stars.unionByName(more))

    joined = classes.select("cid", "rep").join(found, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    labelled = joined.join(least, "component").select("cid", "component_id", "component")
    out = rows.select("doc_id", "key", "n_shingles", "cid").join(labelled, "cid", "left")
    own = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.withColumn("component_id", own)


def distinct_documents(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: the least id that is not null, or else null.

    Rows are told apart by id, null or not, and a hash of the text, so a row with a null id or with
    an id that stands for another text too is judged by its own text.  Rows without words are linked
    with nothing and stay, equal ones of one id once.
    """
    found = _labelled(docs, shingle)
    kept = found.where("cid IS NOT NULL").groupBy("component").agg(_least().alias("at"))
    empty = found.where("cid IS NULL AND doc_id IS NOT NULL").select("doc_id", "key").distinct()
    kept = kept.select("at.doc_id", "at.key").unionByName(empty).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    own = packed(docs, _own=F.col("doc_id"), _text=F.xxhash64("text"), _words=n_words(F.col("text")))
    held = own.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")), "left_semi").dropDuplicates(["_own", "_text"])
    return held.unionByName(own.where("_own IS NULL AND _words = 0")).select("_row.*")
