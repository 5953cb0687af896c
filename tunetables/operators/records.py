"""Training-log records: parsing, routing, normalising, unpivoting, summarising."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.functions.numbers import round4
from tunetables.functions.text import strip

# Optional metrics kept from an evaluation record.
EVAL_METRICS = [
    "eval_accuracy",
    "eval_f1",
    "eval_precision",
    "eval_recall",
    "eval_runtime",
    "eval_samples_per_second",
    "eval_steps_per_second",
]
# Evaluation rewards, stored without their "eval_" prefix.
EVAL_REWARDS = [
    "eval_rewards/chosen",
    "eval_rewards/rejected",
    "eval_rewards/accuracies",
    "eval_rewards/margins",
]
# Optional metrics kept from a training step record.
STEP_METRICS = [
    "num_tokens",
    "mean_token_accuracy",
    "rewards/chosen",
    "rewards/rejected",
    "rewards/accuracies",
    "rewards/margins",
    "logps/chosen",
    "logps/rejected",
    "logits/chosen",
    "logits/rejected",
    "sft_loss",
    "odds_ratio_loss",
    "nll_loss",
]
# Metrics drawn for each kind of training, and the default list.
METRICS_TO_PLOT = {
    "sft": [
        "loss",
        "eval_loss",
        "grad_norm",
        "learning_rate",
        "num_tokens",
        "mean_token_accuracy",
    ],
    "dpo": [
        "loss",
        "eval_loss",
        "rewards/chosen",
        "rewards/rejected",
        "rewards/accuracies",
        "rewards/margins",
        "logps/chosen",
        "logps/rejected",
        "logits/chosen",
        "logits/rejected",
    ],
    "orpo": [
        "loss",
        "eval_loss",
        "sft_loss",
        "eval_sft_loss",
        "odds_ratio_loss",
        "eval_odds_ratio_loss",
        "nll_loss",
        "eval_nll_loss",
        "rewards/chosen",
        "rewards/rejected",
        "rewards/accuracies",
        "rewards/margins",
        "logps/chosen",
        "logps/rejected",
        "logits/chosen",
        "logits/rejected",
    ],
}
DEFAULT_METRICS = ["loss", "learning_rate", "grad_norm", "rewards/accuracies"]

# Keys of a record that are not metrics.
RECORD_KEYS = ["type", "step", "epoch"]
PREVIEW_CHARS = 50
JSON_MAP = "map<string,string>"
FLOAT_TEXT = r"^(?:-?[0-9]+(?:\.[0-9]+(?:[eE][-+]?[0-9]+)?|[eE][-+]?[0-9]+)|NaN|-?Infinity)$"
# Spellings the parser gives to non-finite numbers.
NON_FINITE = ['"NaN"', '"Infinity"', '"-Infinity"']


def _json_objects(text: Column) -> Column:
    """Array of the one map a JSON object gives, or of NULL when text is not one.

    The parser stops at the first complete value, so the text is read as the first
    element of an array with an end mark behind it: anything left over after the
    object shows as a missing or misplaced mark.  Wrapping the result binds it to a
    name, so each text is parsed once however often the result is used.
    """
    marked = F.concat(F.lit("["), text, F.lit(',{"end":1}]'))

    def whole_object(parts: Column) -> Column:
        ended = F.try_element_at(F.get(parts, F.lit(1)), F.lit("end")) == "1"
        unquoted = F.transform_values(
            _last_wins(F.get(parts, F.lit(0))),
            lambda _, v: F.when(v.isin(NON_FINITE), F.trim(v, F.lit('"'))).otherwise(v),
        )
        return F.when((F.size(parts) == 2) & ended, unquoted)

    return F.transform(F.array(F.from_json(marked, f"array<{JSON_MAP}>")), whole_object)


def _last_wins(record: Column) -> Column:
    """Of repeated keys keep the last; maps with one value per key stay as they are."""
    keys = F.map_keys(record)
    comes_again = lambda e, i: F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"])
    kept = F.filter(F.map_entries(record), lambda e, i: ~comes_again(e, i))
    single = F.size(F.array_distinct(keys)) == F.size(keys)
    return F.when(single, record).otherwise(F.map_from_entries(kept))


def json_object(text: Column) -> Column:
    """A JSON object as a map of raw values; NULL when it is not one whole object."""
    return F.get(_json_objects(text), F.lit(0))


def with_record(df: DataFrame, text: str) -> DataFrame:
    """Replace a JSON column by ``record`` (map); rows that are no JSON object drop out.

    Written as a generator, through which no later filter is pushed: a pushed filter
    would parse the text again for each use of the record.
    """
    others = [c for c in df.columns if c != text]
    found = F.array_compact(_json_objects(strip(F.col(text))))
    return df.select(*others, F.explode(found).alias("record"))


def parsed_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``record`` (map) and ``status``: good, blank or bad.

    Permissive reading: bad lines stay whole in ``bad_line``, with a 50-character ``preview``.
    """
    others = [c for c in lines.columns if c != line]
    text = strip(F.col(line))
    parsed = lines.select(*others, F.col(line).alias("_line"), text.alias("_text"), F.explode(_json_objects(text)).alias("record"))
    status = (
        F.when(F.col("_text") == "", "blank").when(F.col("record").isNull(), "bad").otherwise("good")
    )
    preview = F.when(F.col("status") == "bad", F.substring("_text", 1, PREVIEW_CHARS))
    return parsed.withColumn("status", status).withColumn("preview", preview).withColumn(
        "bad_line", F.when(F.col("status") == "bad", F.col("_line"))
    ).drop("_text", "_line")


def good_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Records of the good lines."""
    return with_record(lines, line)


def strict_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """Strict reading: the first line that is not a JSON object fails the job.

    The check is a filter, so it holds whichever columns are read later; a NULL line fails too.
    """
    text = F.coalesce(F.col(line), F.lit("NULL"))
    failure = F.raise_error(F.concat(F.lit("not a log record: "), text)).cast("boolean")
    checked = lines.where(F.when(json_object(F.col(line)).isNotNull(), True).otherwise(failure))
    return checked.withColumn("record", json_object(F.col(line))).drop(line)


def record_kind(record: Column, log_steps: bool = True) -> Column:
    """``eval``, ``step``, or NULL for records that are not logged."""
    step = F.lit("step") if log_steps else F.lit(None).cast("string")
    return F.when(F.map_contains_key(record, "train_runtime"), F.lit(None).cast("string")).otherwise(
        F.when(F.map_contains_key(record, "eval_loss"), "eval").otherwise(step)
    )


def number(record: Column, key: str, default: float | None = None) -> Column:
    value = F.try_element_at(record, F.lit(key)).try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def is_float_text(text: Column) -> Column:
    """A JSON number with a fraction or exponent, or a non-finite one."""
    return text.rlike(FLOAT_TEXT)


def rounded_text(text: Column) -> Column:
    """Floats to four places; every other value as it was."""
    return F.when(is_float_text(text), round4(text.try_cast("double")).cast("string")).otherwise(text)


def renamed_reward(key: Column) -> Column:
    """``eval_rewards/x`` becomes ``rewards/x``; other keys stay."""
    return F.when(key.isin(EVAL_REWARDS), F.replace(key, F.lit("eval_"), F.lit(""))).otherwise(key)


def _optional(record: Column, names: Sequence[str], keep_all: bool, fixed: Sequence[str]) -> Column:
    """Entries of the record that are kept, renamed and rounded, as a map."""
    if keep_all:
        skip = [*fixed, *RECORD_KEYS]
        # a plain reward gives way to the evaluation reward that takes its name; other keys are not looked up
        taken = lambda k: reduce(
            Column.__or__, [(k == name.removeprefix("eval_")) & F.map_contains_key(record, name) for name in EVAL_REWARDS]
        )
        kept = F.map_filter(record, lambda k, _: ~k.isin(skip) & ~taken(k))
    else:
        kept = F.map_filter(record, lambda k, _: k.isin(list(names)))
    renamed = F.transform_keys(kept, lambda k, _: renamed_reward(k))
    return F.transform_values(renamed, lambda _, v: rounded_text(v))


def normalised(
    raw: DataFrame, logs: str = "logs", log_steps: bool = True, keep_all: bool = True
) -> DataFrame:
    """Trainer records as ``type, epoch`` and a ``metrics`` map, rounded to 4 places.

    Missing ``epoch``, ``loss``, ``eval_loss`` and ``learning_rate`` become 0, a zero
    or missing ``grad_norm`` becomes null, ``learning_rate`` is not rounded.  All other
    metrics are kept; without ``keep_all`` only the listed ones are.  Works on static and
    streaming tables alike: the whole step is one narrow projection.
    """
    record = F.col("record")
    rounded = lambda key: round4(number(record, key, 0.0)).cast("string")
    grad = F.nullif(number(record, "grad_norm"), F.lit(0.0))
    eval_fixed = F.create_map(F.lit("eval_loss"), rounded("eval_loss"))
    step_fixed = F.create_map(
        F.lit("loss"),
        rounded("loss"),
        F.lit("learning_rate"),
        number(record, "learning_rate", 0.0).cast("string"),
        F.lit("grad_norm"),
        round4(grad).cast("string"),
    )
    metrics = F.when(
        F.col("type") == "eval",
        F.map_concat(
            eval_fixed, _optional(record, EVAL_METRICS + EVAL_REWARDS, keep_all, ["eval_loss"])
        ),
    ).otherwise(
        F.map_concat(
            step_fixed,
            _optional(record, STEP_METRICS, keep_all, ["loss", "learning_rate", "grad_norm"]),
        )
    )
    return (
        with_record(raw, logs)
        .withColumn("type", record_kind(record, log_steps))
        .where(F.col("type").isNotNull())
        .withColumn("epoch", round4(number(record, "epoch", 0.0)))
        .withColumn("metrics", metrics)
        .drop("record")
    )


def _json_value(text: Column) -> Column:
    bare = (
        is_float_text(text)
        | text.rlike("^-?[0-9]+$")
        | text.isin("true", "false")
        | text.rlike(r"^[\[{]")
    )
    quoted = F.regexp_extract(F.to_json(F.array(text)), r"(?s)^\[(.*)\]$", 1)
    return F.when(text.isNull(), "null").when(bare, text).otherwise(quoted)


def record_line(type_: Column, step: Column, epoch: Column, metrics: Column) -> Column:
    """Compact JSON text of a record, as one log line."""
    head = F.concat(
        F.lit('{"type":"'),
        type_,
        F.lit('","step":'),
        step.cast("string"),
        F.lit(',"epoch":'),
        epoch.cast("string"),
    )
    entries = F.transform(
        F.map_entries(metrics),
        lambda e: F.concat(F.lit(',"'), e["key"], F.lit('":'), _json_value(e["value"])),
    )
    return F.concat(head, F.array_join(entries, ""), F.lit("}"))


def series_records(records: DataFrame) -> DataFrame:
    """``(run_id, line_no, series, step, epoch, record)`` of parsed log records.

    Summaries are dropped; ``eval`` records form the eval series and everything else
    the train series.  Missing step and epoch become 0.
    """
    kind = F.try_element_at("record", F.lit("type"))
    return records.where(~kind.eqNullSafe(F.lit("summary"))).select(
        "run_id",
        "line_no",
        F.when(kind == "eval", "eval").otherwise("train").alias("series"),
        number(F.col("record"), "step", 0.0).cast("long").alias("step"),
        number(F.col("record"), "epoch", 0.0).alias("epoch"),
        "record",
    )


def with_metrics(series: DataFrame, names: Sequence[str]) -> DataFrame:
    """Records cut down to the named metrics."""
    kept = F.map_filter("record", lambda k, _: k.isin(list(names)))
    return series.withColumn("record", kept)


def unpivoted(series: DataFrame) -> DataFrame:
    """One row per metric value: record keys and nulls dropped."""
    values = F.map_filter("record", lambda k, v: ~k.isin(RECORD_KEYS) & v.isNotNull())
    return series.select(
        *[c for c in series.columns if c != "record"], F.explode(values).alias("metric", "_text")
    ).select(
        *[c for c in series.columns if c != "record"],
        "metric",
        F.col("_text").try_cast("double").alias("value"),
    )


def wide_view(records: DataFrame) -> DataFrame:
    """Fixed columns of every record, nulls kept."""
    return records.select(
        "run_id",
        "line_no",
        *[
            number(F.col("record"), key).alias(key)
            for key in ("epoch", "loss", "grad_norm", "learning_rate", "rewards/accuracies")
        ],
    )


def run_losses(series: DataFrame) -> DataFrame:
    """Smallest and last training loss of each run."""
    loss = number(F.col("record"), "loss")
    return _best_and_last(series.where(F.col("series") == "train"), loss, "loss")


def run_eval_losses(series: DataFrame) -> DataFrame:
    """Best and final evaluation loss of each run."""
    loss = number(F.col("record"), "eval_loss")
    return _best_and_last(series.where(F.col("series") == "eval"), loss, "eval_loss")


def _best_and_last(rows: DataFrame, loss: Column, name: str) -> DataFrame:
    return (
        rows.select("run_id", "line_no", loss.alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("run_id")
        .agg(F.min("v").alias(f"best_{name}"), F.max_by("v", "line_no").alias(f"final_{name}"))
    )


def run_extent(series: DataFrame) -> DataFrame:
    """Largest epoch and step of each run's training series."""
    return (
        series.where(F.col("series") == "train")
        .groupBy("run_id")
        .agg(F.max("epoch").alias("max_epoch"), F.max("step").alias("max_step"))
    )


def run_summaries(records: DataFrame) -> DataFrame:
    """One summary row per run, from its records."""
    kind = F.try_element_at("record", F.lit("type"))
    is_summary = kind.eqNullSafe(F.lit("summary"))
    record = F.col("record")
    return records.groupBy("run_id").agg(
        F.max(F.when(~is_summary, number(record, "step", 0.0))).cast("long").alias("total_steps"),
        F.max(F.when(~is_summary, number(record, "epoch", 0.0))).alias("total_epochs"),
        F.min(F.when(kind == "eval", number(record, "eval_loss"))).alias("best_metric"),
        F.bool_or(is_summary).alias("training_completed"),
    )


def series_sizes(series: DataFrame) -> DataFrame:
    """Records per run and series."""
    return series.groupBy("run_id", "series").agg(F.count("*").alias("points"))


def metric_sizes(long: DataFrame) -> DataFrame:
    """Values per run, series and metric: the list of metrics available."""
    return long.groupBy("run_id", "series", "metric").agg(F.count("*").alias("points"))


def best_eval_step(series: DataFrame) -> DataFrame:
    """Step with the smallest evaluation loss, the earliest on ties."""
    loss = number(F.col("record"), "eval_loss")
    return (
        series.where((F.col("series") == "eval") & loss.isNotNull())
        .groupBy("run_id")
        .agg(F.min(F.struct(loss.alias("eval_loss"), "step")).alias("b"))
        .select(
            "run_id",
            F.col("b.step").alias("best_step"),
            F.col("b.eval_loss").alias("best_eval_loss"),
        )
    )
