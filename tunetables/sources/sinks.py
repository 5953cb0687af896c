"""File outputs: training text, predictions, example reports, evaluation documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.operators.reports import EXAMPLES_HEADER, example_report, prediction_report
from tunetables.operators.score_tables import nested_metrics


def write_training_text(texts: DataFrame, path: str) -> str:
    """One ``{"text": ...}`` object per line."""
    texts.select("text").write.json(path)
    return path


def write_predictions(rows: DataFrame, path: str) -> str:
    """The predictions file, in key order, as ordered part files."""
    blocks = prediction_report(rows)
    ordered = blocks.repartitionByRange("idx").sortWithinPartitions("idx")
    ordered.select("text").write.text(path)
    return path


def write_examples(rows: DataFrame, path: str, num_examples: int = 5) -> str:
    """The sample report: a header and the first examples, in one small file."""
    header = rows.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("idx"), F.lit(EXAMPLES_HEADER).alias("text")
    )
    blocks = header.unionByName(example_report(rows, num_examples))
    blocks.repartition(1).sortWithinPartitions("idx").select("text").write.text(path)
    return path


def write_evaluation(
    metrics: DataFrame,
    pairs: DataFrame,
    path: str,
    dataset: dict[str, str],
    model: dict[str, str],
    dataset_size: int,
) -> str:
    """The evaluation document, with predictions and references as a table beside it.

    ``metrics`` is the one-row metric table, nested by metric.  Both the size of the dataset and the
    number of rows actually evaluated are stated.
    """
    evaluated = pairs.agg(F.count("*")).scalar()
    metrics.select(
        nested_metrics(metrics.columns).alias("metrics"),
        F.struct(
            F.lit(dataset["name"]).alias("name"),
            F.lit(dataset["split"]).alias("split"),
            F.lit(dataset_size).cast("long").alias("size"),
            evaluated.alias("evaluated"),
        ).alias("dataset_info"),
        F.struct(F.lit(model["id"]).alias("id"), F.lit(model["device"]).alias("device")).alias(
            "model_info"
        ),
    ).write.json(f"{path}/document")
    pairs.select("pair_id", "prediction", "reference").write.json(f"{path}/pairs")
    return path
