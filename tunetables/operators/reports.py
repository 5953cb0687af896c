"""Readable reports of prompts, references and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Headers, labels and rules that the reports must show.
EXAMPLES_HEADER = "--- Examples (Prediction vs. Reference) ---"
EXAMPLE_RULE = "-" * 30
PREDICTION_RULE = "-" * 40
EXAMPLE_TITLE, PREDICTION_TITLE = "\n--- Example %d ---", "Example %d"
EXAMPLE_LABELS = {"prompt": "Prompt: ", "reference": "Reference (Chosen): ", "prediction": "Model Prediction: "}
PREDICTION_LABELS = {"prediction": "Prediction: ", "reference": "Reference: "}


def triples(
    prompts: DataFrame, references: DataFrame, predictions: DataFrame, n: int | None = None
) -> DataFrame:
    """``(idx, prompt, reference, prediction)`` joined by key, for the first ``n`` rows."""
    parts = [prompts.select("idx", "prompt"), references.select("idx", "reference")]
    parts.append(predictions.select("idx", "prediction"))
    if n is not None:
        parts = [p.where(F.col("idx") < n) for p in parts]
    return parts[0].join(parts[1], "idx").join(parts[2], "idx")


def _labelled(label: str, text: str) -> Column:
    return F.concat(F.lit(label), F.coalesce(F.col(text), F.lit("")))


def example_report(rows: DataFrame, num_examples: int = 5) -> DataFrame:
    """``(idx, text)``: the sample report's block for each of the first examples."""
    block = F.concat_ws(
        "\n",
        F.format_string(EXAMPLE_TITLE, F.col("idx") + 1),
        *[_labelled(label, column) for column, label in EXAMPLE_LABELS.items()],
        F.lit(EXAMPLE_RULE),
    )
    return rows.where(F.col("idx") < num_examples).select("idx", block.alias("text"))


def prediction_report(rows: DataFrame) -> DataFrame:
    """``(idx, text)``: the predictions file's block for each row."""
    block = F.concat_ws(
        "\n",
        F.format_string(PREDICTION_TITLE, F.col("idx") + 1),
        *[_labelled(label, column) for column, label in PREDICTION_LABELS.items()],
        F.lit(PREDICTION_RULE),
    )
    return rows.select("idx", block.alias("text"))
