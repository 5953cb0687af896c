"""Evaluation: generate answers, pair them with references, score, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.operators import embedding_match, ngrams, pairs, rouge_lcs
from tunetables.operators.generation import Generator, early_rows, generated, paired
from tunetables.operators.reports import triples
from tunetables.operators.score_tables import long_scores, mean_scores
from tunetables.session import written
from tunetables.sources.sinks import write_evaluation, write_examples, write_predictions

ROUGE = ["rouge1", "rouge2", "rougeL", "rougeLsum"]


def predictions(
    rows: DataFrame,
    load: Callable[[], Generator],
    batch_size: int = 4,
    early_stop: bool = False,
    tasks: int | None = None,
    by_length: bool = False,
) -> DataFrame:
    """``(pair_id, prediction, reference)`` of preference rows, written once.

    Generation is costly, and every metric reads its output, so it is stored.
    ``early_stop`` keeps the first three batches only; ``tasks`` and ``by_length`` are those
    of ``generated``.
    """
    wanted = early_rows(rows, batch_size) if early_stop else rows
    answers = generated(wanted.select("idx", "prompt"), load, batch_size, tasks=tasks, by_length=by_length)
    return written(paired(answers, pairs.references(wanted)), "predictions")


def pair_scores(scored: DataFrame, token_embeddings: DataFrame | None = None) -> DataFrame:
    """ROUGE scores of each pair and, if given vectors, its BERTScore ``precision, recall, f1``.

    A pair without vectors has NULL there.
    """
    lcs = rouge_lcs.with_rouge_lsum(rouge_lcs.with_rouge_l(scored))
    scores = ngrams.rouge_n(scored).join(lcs.select("pair_id", "rougeL", "rougeLsum"), "pair_id")
    if token_embeddings is None:
        return scores
    return scores.join(embedding_match.embedding_scores(token_embeddings), "pair_id", "left")


def _with_means(scored: DataFrame, scores: DataFrame) -> DataFrame:
    """BLEU with its parts, beside the means of stored or derived pair scores."""
    found = {name: name for name in ROUGE} | ({"f1": "bertscore"} if "f1" in scores.columns else {})
    means = mean_scores(scores, list(found)).select(F.struct(*found)).scalar()
    return ngrams.corpus_bleu(scored).select("*", *[means.getField(c).alias(name) for c, name in found.items()])


def corpus_metrics(scored: DataFrame, token_embeddings: DataFrame | None = None) -> DataFrame:
    """One row: BLEU with its parts, mean ROUGE scores and, if given vectors, BERTScore."""
    metrics = _with_means(scored, pair_scores(scored))
    if token_embeddings is not None:
        f1 = embedding_match.embedding_scores(token_embeddings)
        metrics = metrics.withColumn("bertscore", f1.agg(F.avg("f1")).scalar())
    return metrics


def evaluate(
    rows: DataFrame,
    load: Callable[[], Generator],
    path: str,
    dataset: dict[str, str],
    model: dict[str, str],
    embed: Callable[[DataFrame], DataFrame] | None = None,
    num_examples: int = 5,
    **generation,
) -> DataFrame:
    """Generate answers to preference rows, score them and store all results under ``path``.

    ``document`` and ``pairs`` are those of ``write_evaluation``, ``scores`` has the figures of
    every pair, ``predictions`` and ``examples`` are readable reports.  ``embed`` turns the
    stored pairs into token vectors; ``generation`` goes to ``predictions``.  Returns the short
    table ``(metric, value)``: BLEU, ROUGE-L and, with vectors, BERTScore.
    """
    scored = predictions(rows, load, **generation)
    pair_scores(scored, embed(scored) if embed else None).write.parquet(f"{path}/scores")
    scores = rows.sparkSession.read.parquet(f"{path}/scores")
    metrics = written(_with_means(scored, scores), "metrics")
    write_evaluation(metrics, scored, path, dataset, model, rows.count())
    answers = scored.select(F.col("pair_id").alias("idx"), "prediction")
    reports = triples(rows, pairs.references(rows), answers)
    write_predictions(reports, f"{path}/predictions")
    write_examples(reports, f"{path}/examples", num_examples)
    return long_scores(metrics, ["bleu", "rougeL", *(["bertscore"] if embed else [])])
