"""N-gram overlap between predictions and references; BLEU and ROUGE-N from it.

Pairs are hash-distributed by ``pair_id`` once, as whole texts, and gathered to one row
a key.  The grams of a key are counted and clipped inside its row: neither positions
nor grams become rows of their own, so nothing but texts is shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.functions.numbers import f1
from tunetables.functions.text import bleu_tokens, rouge_tokens

BLEU_ORDER = 4
# Words of both sides that are counted at a time: what a worker holds, whatever the batch.
SLICE_WORDS = 1 << 20

_SUMS = "array<struct<n int, overlap long, n_prediction long, n_reference long>>"
_GRAMS = "array<struct<n int, gram string, in_prediction long, in_reference long>>"


def _sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _count_slice(prediction: pa.ListArray, reference: pa.ListArray, max_n: int, each: bool) -> pa.ListArray:
    """Counts of a few rows, whose sides are lists of split texts: a row's sums by order, or ``each`` of its grams."""
    rows = len(prediction)
    texts = [side.flatten() for side in (prediction, reference)]
    length = np.concatenate([_sizes(t) for t in texts])
    row = np.concatenate([np.repeat(np.arange(rows), _sizes(side)) for side in (prediction, reference)])
    row, here = np.repeat(row, length), np.arange(length.sum())
    left = np.repeat(np.cumsum(length), length) - here  # words from here to the text's end
    in_prediction = here < _sizes(texts[0]).sum()
    words = pa.concat_arrays([t.flatten() for t in texts])
    coded = words.dictionary_encode()
    code = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64)
    n_words = max(len(coded.dictionary), 1)
    # a gram is known by its row and first words (a dense number) and its last word
    at, known = here, row
    parts = []
    for n in range(1, max_n + 1):
        whole = left[at] >= n
        at, known = at[whole], known[whole]
        whole = code[at + n - 1] >= 0
        at, known = at[whole], known[whole]
        _, first, known = np.unique(known * n_words + code[at + n - 1], return_index=True, return_inverse=True)
        p = np.bincount(known, weights=in_prediction[at], minlength=len(first)).astype(np.int64)
        r = np.bincount(known, minlength=len(first)) - p
        of, start, found = row[at[first]], at[first], [p, r]
        if not each:
            found = [np.bincount(of, weights=c, minlength=rows).astype(np.int64) for c in (np.minimum(p, r), p, r)]
        if not each or n == 1:
            # without any word a row still has its sums of order 1, or a NULL gram
            present = np.bincount(of, minlength=rows) > 0
            shown = np.flatnonzero(~present if each else present | (n == 1))
            empty = np.zeros(len(shown), dtype=np.int64)
            parts.append((shown, empty + n, empty - 1, *([empty, empty] if each else [c[shown] for c in found])))
        if each:
            parts.append((of, np.full(len(of), n), start, *found))
    of, order, start, *found = (np.concatenate(column) for column in zip(*parts, strict=True))
    by_row = np.argsort(of, kind="stable")
    fields = {"n": pa.array(order[by_row], pa.int32())}
    if each:
        places = zip(start[by_row].tolist(), order[by_row].tolist(), strict=True)
        grams = [" ".join(words.slice(s, n).to_pylist()) if s >= 0 else None for s, n in places]
        fields["gram"] = pa.array(grams, pa.string())
    names = ["in_prediction", "in_reference"] if each else ["overlap", "n_prediction", "n_reference"]
    fields |= {name: pa.array(c[by_row], pa.int64()) for name, c in zip(names, found, strict=True)}
    offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))])
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    )


def _counter(max_n: int, each: bool, slice_words: int) -> Callable[[pa.Array, pa.Array], pa.Array]:
    def words_of(side: pa.ListArray) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(_sizes(side.flatten()))])
        ends = np.cumsum(_sizes(side))
        return before[ends]

    def counted(prediction: pa.Array, reference: pa.Array) -> pa.Array:
        slices = (words_of(prediction) + words_of(reference)) // slice_words
        edges = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(slices)]
        return pa.concat_arrays(
            [
                _count_slice(prediction.slice(low, high - low), reference.slice(low, high - low), max_n, each)
                for low, high in zip(edges[:-1], edges[1:], strict=True)
            ]
        )

    return counted


def _counted(
    pairs: DataFrame,
    splitter: Callable[[Column], Column],
    max_n: int,
    by: Sequence[str],
    clustered: bool,
    each: bool = False,
) -> DataFrame:
    """What ``_count_slice`` finds, from one row for each key."""
    placed = pairs if clustered else pairs.repartition("pair_id")
    sides = ["prediction", "reference"]
    # texts that are NULL have no words, and collecting leaves them out
    keyed = placed.groupBy(*by, "pair_id").agg(*[F.collect_list(side).alias(side) for side in sides])
    # the usual single text is split outside the function over arrays, which would run uncompiled
    split = [
        F.when(F.size(side) == 1, F.array(splitter(F.element_at(side, 1)))).otherwise(F.transform(side, splitter))
        for side in sides
    ]
    # non-deterministic marking keeps the optimiser from counting twice
    count = F.arrow_udf(_counter(max_n, each, SLICE_WORDS), _GRAMS if each else _SUMS).asNondeterministic()
    return keyed.select(*by, "pair_id", count(*split).alias("_found")).select(*by, "pair_id", F.inline("_found"))


def gram_counts(
    pairs: DataFrame,
    splitter: Callable[[Column], Column],
    max_n: int,
    by: Sequence[str] = (),
    clustered: bool = False,
) -> DataFrame:
    """``(by..., pair_id, n, gram, in_prediction, in_reference)`` counts.

    A pair without any token keeps one row with a NULL gram and zero counts.
    ``clustered`` says rows are already hash-distributed by ``pair_id``.
    """
    return _counted(pairs, splitter, max_n, by, clustered, each=True)


def overlaps(
    pairs: DataFrame,
    splitter: Callable[[Column], Column],
    max_n: int,
    by: Sequence[str] = (),
    clustered: bool = False,
) -> DataFrame:
    """Clipped overlap and gram totals: ``(by..., pair_id, n, overlap, n_prediction, n_reference)``.

    Orders longer than both texts have no row.  Rows with the same key count as one pair.
    """
    return _counted(pairs, splitter, max_n, by, clustered).withColumn("n", F.col("n").cast("long"))


def corpus_bleu(
    pairs: DataFrame, by: Sequence[str] = (), clustered: bool = False, order: int = BLEU_ORDER
) -> DataFrame:
    """Corpus BLEU, one row per group: score, precisions, brevity penalty and lengths."""
    return bleu_from_overlaps(overlaps(pairs, bleu_tokens, order, by, clustered), by, order)


def bleu_from_overlaps(found: DataFrame, by: Sequence[str] = (), order: int = BLEU_ORDER) -> DataFrame:
    at = lambda n, c: F.coalesce(F.sum(F.when(F.col("n") == n, F.col(c))), F.lit(0))
    orders = range(1, order + 1)
    sums = found.groupBy(*by).agg(
        *[at(n, "overlap").alias(f"_m{n}") for n in orders],
        *[at(n, "n_prediction").alias(f"_t{n}") for n in orders],
        at(1, "n_prediction").alias("translation_length"),
        at(1, "n_reference").alias("reference_length"),
    )
    zero, one = F.lit(0.0), F.lit(1.0)
    precision = [
        F.when(F.col(f"_t{n}") > 0, F.col(f"_m{n}") / F.col(f"_t{n}")).otherwise(zero) for n in orders
    ]
    ratio = F.when(
        F.col("reference_length") > 0, F.col("translation_length") / F.col("reference_length")
    ).otherwise(zero)
    penalty = (
        F.when(F.col("length_ratio") > 1, one)
        .when(F.col("length_ratio") > 0, F.exp(one - one / F.col("length_ratio")))
        .otherwise(zero)
    )
    names = [F.col(f"precision_{n}") for n in orders]
    logs = sum((F.ln(p) for p in names[1:]), F.ln(names[0]))
    score = F.when(F.least(*names) > 0, F.exp(logs / order) * F.col("brevity_penalty")).otherwise(zero)
    return (
        sums.select(
            *by,
            *[p.alias(f"precision_{n}") for n, p in zip(orders, precision, strict=True)],
            "translation_length",
            "reference_length",
        )
        .withColumn("length_ratio", ratio)
        .withColumn("brevity_penalty", penalty)
        .withColumn("bleu", score)
    )


def rouge_n(
    pairs: DataFrame, max_n: int = 2, by: Sequence[str] = (), clustered: bool = False
) -> DataFrame:
    """ROUGE-1..n F1 of each pair, as columns ``rouge1``, ``rouge2``, ..."""
    score = f1(F.col("overlap"), F.col("n_prediction"), F.col("n_reference"))
    return (
        overlaps(pairs, rouge_tokens, max_n, by, clustered)
        .withColumn("f1", score)
        .groupBy(*by, "pair_id")
        .agg(
            *[
                F.coalesce(F.max(F.when(F.col("n") == n, F.col("f1"))), F.lit(0.0)).alias(f"rouge{n}")
                for n in range(1, max_n + 1)
            ]
        )
    )
