"""What the corpus operators share: reading, words, and state kept by a Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII blanks.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"



def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: str | None, lower: bool = False) -> list[str]:
    """Words of a text, whose letters A-Z are lower-cased on request; none for null.

    >>> words_of(" A\\u00a0b  C\\n", lower=True)
    ['a\\xa0b', 'c']
    """
    found = (text or "").encode("utf-8", "surrogatepass")
    # on bytes, lower() and split() know ASCII only
    return [w.decode("utf-8", "surrogatepass") for w in (found.lower() if lower else found).split()]


def n_words(text: Column) -> Column:
    """Number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct column ``_row`` beside ``keys``, so that no name of theirs can clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in keys.items()])


def worker_store(name: str) -> dict:
    """A dictionary that lasts as long as the Python worker, for bounded caches."""
    module = sys.modules.setdefault("_tunetables_worker", types.ModuleType("_tunetables_worker"))
    return module.__dict__.setdefault(name, {})


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit integer hash that spreads every bit (the splitmix finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS.encode(), np.uint8))
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def hashed_words(texts: Sequence[str | None]) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words with A-Z lower-cased, the same on every machine and run.

    A word's hash is the sum over its bytes of a number for the byte times a number for its place,
    mixed with its length; all words of the texts are summed at once.
    """
    blobs = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *blobs, b""]).lower(), np.uint8)
    blank = _IS_BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in texts]
    lengths = ends - starts
    inside = np.flatnonzero(~blank)
    first = np.cumsum(lengths) - lengths
    places = np.arange(len(inside)) - np.repeat(first, lengths)
    by_place = mixed(np.arange(7, 7 + int(lengths.max()), dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_BYTES[data[inside]] * by_place[places], first)
        hashes = mixed(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    cuts = np.searchsorted(starts, np.cumsum([1, *(len(b) + 1 for b in blobs)]))
    return [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def in_pieces(texts: Sequence[str | None], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about ``size`` characters each."""
    start = held = 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield start, k + 1
            start, held = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingle_sets(words: Sequence[np.ndarray], size: int) -> list[np.ndarray]:
    """For each list of word hashes the sorted distinct hashes of its runs of ``size`` words.

    Fewer words are one run; no words give no shingle.
    """
    lengths = np.array([len(w) for w in words])
    flat = np.concatenate([*words, np.zeros(size, np.uint64)])
    total = np.zeros(len(flat) - size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + flat[k : k + len(total)])
    out, at = [], 0
    for n, own in zip(lengths.tolist(), words, strict=True):
        if n >= size:
            found = np.sort(total[at : at + n - size + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif n:
            whole = np.zeros(1, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    whole = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + own[k : k + 1])
            out.append(whole)
        else:
            out.append(own)
        at += n
    return out
