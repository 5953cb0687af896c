"""Batched text generation with a caller's function, and pairing of its output."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetables.functions.worker import kept_by_worker
from tunetables.operators.ordering import ranked

BATCH_SIZE = 4
EARLY_BATCHES = 3  # batches evaluated when the early stop is asked for

Generator = Callable[[list[str]], list[str]]


def numbered_batches(prompts: DataFrame, batch_size: int = BATCH_SIZE, key: str = "idx", column: str = "prompt", by_length: bool = False) -> DataFrame:
    """Add ``_batch``: consecutive keys from 0 are cut into batches, ``floor(key / batch_size)``.

    With ``by_length`` prompts are first ranked by length, then key, and ranks are cut, which saves padding.
    Either way a batch depends on the table alone, never on how it is partitioned.
    """
    if by_length:
        placed = ranked(prompts, F.length(column), F.col(key), F.col(column), rank="_place")
        return placed.withColumn("_batch", F.floor(F.col("_place") / batch_size)).drop("_place")
    # rows without a key are batches of their own
    return prompts.withColumn("_batch", F.coalesce(F.floor(F.col(key) / batch_size), F.lit(-1).cast("long")))


def generated(
    prompts: DataFrame,
    load: Callable[[], Generator],
    batch_size: int = BATCH_SIZE,
    column: str = "prompt",
    tasks: int | None = None,
    by_length: bool = False,
    key: str = "idx",
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``prediction``: the generator's answer to each prompt.

    ``load`` runs once per Python worker, which keeps its model between the tasks of this table, and returns
    a function from a list of at most ``batch_size`` prompts to as many answers; it should be deterministic,
    since a lost task is run again.  A batch of ``numbered_batches`` is answered whole, in the order of its
    keys, by one task, so answers that depend on a batch's other prompts are the same on any cluster.
    ``tasks`` spreads few but costly prompts over more tasks than there are cores; ``profile`` asks for
    executors and task resources (an accelerator) for this stage alone.
    """
    out = T.StructType([*prompts.schema.fields, T.StructField("prediction", T.StringType())])
    names = [f.name for f in prompts.schema.fields]
    model = uuid.uuid4().hex

    def replies(generate: Generator, rows: pd.DataFrame) -> pd.DataFrame:
        """Answers to whole batches."""
        answers: list[str] = []
        for _, own in rows.groupby("_batch", sort=False):
            texts = own[column].tolist()
            for start in range(0, len(texts), batch_size):
                batch = texts[start : start + batch_size]
                made = list(generate(batch))
                if len(made) != len(batch):
                    raise ValueError(f"{len(batch)} prompts gave {len(made)} answers")
                answers.extend(made)
        return rows[names].assign(prediction=answers)

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = kept_by_worker("generator", model, load)
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            # the last batch may go on in the next frame
            begun = frame["_batch"] == frame["_batch"].iloc[-1] if len(frame) else frame["_batch"].isna()
            rest = frame[begun]
            if not begun.all():
                yield replies(generate, frame[~begun])
        if rest is not None and len(rest):
            yield replies(generate, rest)

    spread = tasks or prompts.sparkSession.sparkContext.defaultParallelism
    batches = numbered_batches(prompts, batch_size, key, column, by_length)
    source = batches.repartitionByRange(spread, "_batch").sortWithinPartitions("_batch", key, column)
    return source.mapInPandas(answer, out, profile=profile)


def early_rows(df: DataFrame, batch_size: int = BATCH_SIZE, idx: str = "idx") -> DataFrame:
    """Rows evaluated under the early stop: the first three batches."""
    return df.where(F.col(idx) < EARLY_BATCHES * batch_size)


def paired(predictions: DataFrame, references: DataFrame, key: str = "idx") -> DataFrame:
    """Predictions joined to references by key, as ``(pair_id, prediction, reference)``.

    Both sides are distributed by the key before the join, so scoring by pair needs
    no further shuffle (pass ``clustered=True`` there).
    """
    left = predictions.select(F.col(key).alias("pair_id"), "prediction").repartition("pair_id")
    right = references.select(F.col(key).alias("pair_id"), "reference").repartition("pair_id")
    return left.join(right, "pair_id")


def in_order(*parts: DataFrame) -> DataFrame:
    """Batch results put together; order is carried by the key, not by place."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
