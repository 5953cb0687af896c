"""Preference-objective quantities over tables of log-probabilities.

Formulas: direct preference optimisation (Rafailov et al. 2023) and odds-ratio
preference optimisation (Hong et al. 2024).  Per-pair values are projections; the
logged figures are plain means, summed map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.functions.numbers import neg_log_sigmoid

BETA = 0.1
MASKED = -100


def dpo_pairs(pairs: DataFrame, beta: float = BETA) -> DataFrame:
    """Rewards, margin, accuracy and loss of each pair."""
    chosen = beta * (F.col("policy_chosen_logp") - F.col("ref_chosen_logp"))
    rejected = beta * (F.col("policy_rejected_logp") - F.col("ref_rejected_logp"))
    rewards = pairs.withColumn("rewards/chosen", chosen).withColumn("rewards/rejected", rejected)
    margin = F.col("rewards/chosen") - F.col("rewards/rejected")
    return (
        rewards.withColumn("rewards/margins", margin)
        .withColumn(
            "rewards/accuracies",
            (F.col("rewards/chosen") > F.col("rewards/rejected")).cast("double"),
        )
        .withColumn("loss", neg_log_sigmoid(F.col("rewards/margins")))
    )


#: The names under which trainers log these metrics.
DPO_METRICS = ["loss", "rewards/chosen", "rewards/rejected", "rewards/accuracies", "rewards/margins"]


def orpo_pairs(pairs: DataFrame, beta: float = BETA) -> DataFrame:
    """Mean token log-probs, log odds, odds-ratio loss, NLL and total of each pair."""
    c, r = F.col("chosen_mean_logp"), F.col("rejected_mean_logp")
    log_odds = (c - r) - (F.log1p(-F.exp(c)) - F.log1p(-F.exp(r)))
    return (
        pairs.withColumn("chosen_mean_logp", F.col("policy_chosen_logp") / F.col("n_chosen_tokens"))
        .withColumn("rejected_mean_logp", F.col("policy_rejected_logp") / F.col("n_rejected_tokens"))
        .withColumn("log_odds", log_odds)
        .withColumn("odds_ratio_loss", neg_log_sigmoid(F.col("log_odds")))
        .withColumn("nll_loss", -c)
        .withColumn("loss", F.col("nll_loss") + beta * F.col("odds_ratio_loss"))
        .withColumn("rewards/chosen", beta * c)
        .withColumn("rewards/rejected", beta * r)
        .withColumn("rewards/margins", F.col("rewards/chosen") - F.col("rewards/rejected"))
        .withColumn(
            "rewards/accuracies",
            (F.col("rewards/chosen") > F.col("rewards/rejected")).cast("double"),
        )
    )


#: Fixed values, as above.
ORPO_METRICS = [
    "loss",
    "nll_loss",
    "odds_ratio_loss",
    "log_odds",
    "rewards/chosen",
    "rewards/rejected",
    "rewards/accuracies",
    "rewards/margins",
]


def means(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """Mean of each column, over everything or by group."""
    return df.groupBy(*by).agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in columns])


def side_means(df: DataFrame, *by: str, logits: bool = False) -> DataFrame:
    """``logps/*`` (and ``logits/*``) means of both sides."""
    sides = {
        "logps/chosen": "policy_chosen_logp",
        "logps/rejected": "policy_rejected_logp",
    }
    if logits:
        sides |= {"logits/chosen": "chosen_logit", "logits/rejected": "rejected_logit"}
    return df.groupBy(*by).agg(*[F.avg(source).alias(name) for name, source in sides.items()])


def token_metrics(scores: DataFrame, *by: str) -> DataFrame:
    """Token count, accuracy and NLL over unmasked labels."""
    hit = (F.col("argmax_id") == F.col("label_id")).cast("double")
    return (
        scores.where(F.col("label_id") != MASKED)
        .groupBy(*by)
        .agg(
            F.count("*").alias("num_tokens"),
            F.avg(hit).alias("mean_token_accuracy"),
            (-F.avg("label_logp")).alias("nll_loss"),
        )
    )
