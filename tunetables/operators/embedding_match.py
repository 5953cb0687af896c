"""Greedy token matching by cosine similarity, and BERTScore-style P/R/F1 from it.

Tasks compare one tile of prediction tokens with one tile of reference tokens, at
most ``TILE`` a side, as a matrix product, and take any number of such pairs from a batch.  A text an encoder takes is a single tile;
a longer one is compared tile by tile and its partial maxima are combined, so no task
holds a whole long text and results stay exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.session import lookup, written

TILE = 1024
TILE_PAIR = ["pair_id", "pred_tile", "ref_tile"]


def _tiled(tokens: DataFrame, tile: int) -> DataFrame:
    """Tokens with their ``pred_tile`` and ``ref_tile``, once per tile they are compared with.

    Only texts of several tiles need to know the other side's length; they are listed
    from a pass that reads no vectors.
    """
    last = lambda side: F.coalesce(
        F.max(F.when(F.col("side") == side, F.floor(F.col("pos") / tile))), F.lit(0)
    )
    long_texts = written(
        tokens.groupBy("pair_id")
        .agg(last("pred").alias("last_pred"), last("ref").alias("last_ref"))
        .where((F.col("last_pred") > 0) | (F.col("last_ref") > 0)),
        "long-texts",
    )
    own = F.floor(F.col("pos") / tile)
    is_pred = F.col("side") == "pred"
    other_last = F.coalesce(F.when(is_pred, F.col("last_ref")).otherwise(F.col("last_pred")), F.lit(0))
    return (
        lookup(tokens, long_texts, ["pair_id"], spread="pos")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), other_last)))
        .select(
            "pair_id",
            "side",
            F.col("pos").cast("long").alias("pos"),
            "embedding",
            F.when(is_pred, own).otherwise(F.col("other")).alias("pred_tile"),
            F.when(is_pred, F.col("other")).otherwise(own).alias("ref_tile"),
        )
    )


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.tolist(), dtype=np.float64)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _best(tokens: pd.DataFrame) -> pd.DataFrame:
    """Best similarity of each token to the other side of its tile pair; 0 where that side is empty."""
    unit, is_pred = _unit_rows(tokens.embedding), (tokens.side == "pred").to_numpy()
    pairs = tokens[TILE_PAIR].to_numpy()
    edges = np.flatnonzero((pairs[1:] != pairs[:-1]).any(axis=1)) + 1
    best = np.zeros(len(tokens))
    for rows in np.split(np.arange(len(tokens)), edges):
        pred, ref = rows[is_pred[rows]], rows[~is_pred[rows]]
        if len(pred) and len(ref):
            similar = unit[pred] @ unit[ref].T
            best[pred], best[ref] = similar.max(axis=1), similar.max(axis=0)
    return tokens[["pair_id", "side", "pos"]].assign(best=best)


def _best_in_tiles(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Matches of sorted tokens; only a tile pair that the next batch may go on with is held back."""
    held = None
    for part in parts:
        tokens = part if held is None else pd.concat([held, part], ignore_index=True)
        if tokens.empty:
            continue
        is_last = (tokens[TILE_PAIR] == tokens[TILE_PAIR].iloc[-1]).all(axis=1)
        held = tokens[is_last]
        if not is_last.all():
            yield _best(tokens[~is_last])
    if held is not None:
        yield _best(held)


def greedy_matches(tokens: DataFrame, tile: int = TILE) -> DataFrame:
    """``(pair_id, side, pos, best)``: similarity to the closest token on the other side.

    ``tokens`` is ``(pair_id, side, pos, embedding)`` with side ``pred`` or ``ref``, and
    positions counted from 0 on each side.
    """
    return (
        _tiled(tokens, tile)
        .repartition(*TILE_PAIR)
        .sortWithinPartitions(*TILE_PAIR)
        .mapInPandas(_best_in_tiles, "pair_id long, side string, pos long, best double")
        .groupBy("pair_id", "side", "pos")
        .agg(F.max("best").alias("best"))
    )


def embedding_scores(tokens: DataFrame, tile: int = TILE) -> DataFrame:
    """``(pair_id, precision, recall, f1)`` from greedy matches; no idf, no rescaling.

    A pair with an empty side scores 0.
    """
    mean = lambda side: F.coalesce(
        F.avg(F.when(F.col("side") == side, F.col("best"))), F.lit(0.0)
    )
    p, r = F.col("precision"), F.col("recall")
    return (
        greedy_matches(tokens, tile)
        .groupBy("pair_id")
        .agg(mean("pred").alias("precision"), mean("ref").alias("recall"))
        .withColumn("f1", F.when(p + r != 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    )
