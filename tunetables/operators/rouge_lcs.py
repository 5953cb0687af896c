"""ROUGE-L and ROUGE-Lsum of each pair, in one Arrow-batched pass without a shuffle."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.functions.lcs import lcs_length, union_hits
from tunetables.functions.numbers import f1
from tunetables.functions.text import rouge_clean, rouge_clean_lines


def _sentence_counts(prediction: pd.Series, reference: pd.Series) -> pd.DataFrame:
    found = []
    for p, r in zip(prediction, reference, strict=True):
        p, r = p.split(), r.split()
        found.append((lcs_length(p, r), len(p), len(r)))
    return pd.DataFrame(found, columns=["overlap", "n_prediction", "n_reference"])


def _summary_counts(prediction: pd.Series, reference: pd.Series) -> pd.DataFrame:
    found = []
    for p, r in zip(prediction, reference, strict=True):
        p = [s.split() for s in p.split("\n")]
        r = [s.split() for s in r.split("\n")]
        found.append((union_hits(r, p), sum(map(len, p)), sum(map(len, r))))
    return pd.DataFrame(found, columns=["overlap", "n_prediction", "n_reference"])


_COUNTS = "overlap long, n_prediction long, n_reference long"


def _scored(pairs: DataFrame, name: str, counts, clean) -> DataFrame:
    texts = [clean(F.col(c)) for c in ("prediction", "reference")]
    counted = pairs.withColumn("_c", F.pandas_udf(counts, _COUNTS)(*texts))
    score = f1(F.col("_c.overlap"), F.col("_c.n_prediction"), F.col("_c.n_reference"))
    return counted.withColumn(name, score).drop("_c")


def with_rouge_l(pairs: DataFrame) -> DataFrame:
    """Add ``rougeL``: F1 over the longest common subsequence of the whole texts."""
    return _scored(pairs, "rougeL", _sentence_counts, rouge_clean)


def with_rouge_lsum(pairs: DataFrame) -> DataFrame:
    """Add ``rougeLsum``: F1 over the union of sentence subsequences, sentences by line."""
    return _scored(pairs, "rougeLsum", _summary_counts, rouge_clean_lines)
