"""Queries over training logs, checkpoints and log-probability tables."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from catalog.fixtures import (
    checkpoint_entries,
    checkpoint_listing,
    events_stream,
    pair_logps,
    remove_checkpoints,
    table,
    token_scores,
    train_log,
    trainer_raw,
    with_views,
    write_checkpoints,
)
from catalog.registry import query
from tunetables.operators import checkpoints, objectives, records, series, smoothing
from tunetables.plans import curves
from tunetables.sources.checkpoints import checkpoint_folders
from tunetables.session import new_path, removed, written
from tunetables.sources.runlogs import append_log, append_raw_log, append_summaries, numbered_log, read_log
from tunetables.streaming import runlogs as live

WINDOW, FACTOR = 10, 5
SAVGOL_WINDOW = 12  # even: eleven values are used
CURVE_METRICS = ["loss", "eval_loss", "grad_norm", "rewards/margins"]


def raw_records(spark, folder):
    return trainer_raw(table(spark, folder, "events"))


def good(spark, folder):
    return records.good_records(train_log(spark, folder))


def log_series(spark, folder):
    return records.series_records(good(spark, folder))


def log_values(spark, folder):
    return records.unpivoted(log_series(spark, folder))


def rounded(df, *columns, keep=()):
    return df.select(*keep, *[F.round(F.col(f"`{c}`"), 6).alias(c.replace("/", "_")) for c in columns])


METRIC_COLUMNS = ["loss", "eval_loss", "learning_rate", "grad_norm", "eval_runtime", "num_tokens", "rewards/chosen", "rewards/margins", "eval_nll_loss"]


def read_back(spark, path):
    """Stored log lines as typed columns."""
    parsed = records.good_records(read_log(spark, path))
    record = F.col("record")
    return parsed.select(
        "run_id",
        F.element_at(record, "type").alias("type"),
        records.number(record, "step").cast("long").alias("step"),
        records.number(record, "epoch").alias("epoch"),
        *[records.number(record, m).alias(m.replace("/", "_")) for m in METRIC_COLUMNS],
    )


NORMALISED_SQL = """
  SELECT run_id, CASE WHEN logs LIKE '%eval_loss%' THEN 'eval' ELSE 'step' END AS type, step,
         round(CAST(logs->>'$.epoch' AS DOUBLE), 4) AS epoch,
         CASE WHEN logs NOT LIKE '%eval_loss%' THEN round(CAST(logs->>'$.loss' AS DOUBLE), 4) END AS loss,
         round(CAST(logs->>'$.eval_loss' AS DOUBLE), 4) AS eval_loss,
         CAST(logs->>'$.learning_rate' AS DOUBLE) AS learning_rate,
         nullif(round(CAST(logs->>'$.grad_norm' AS DOUBLE), 4), 0) AS grad_norm,
         CAST(logs->>'$.eval_runtime' AS DOUBLE) AS eval_runtime,
         CAST(logs->>'$.num_tokens' AS DOUBLE) AS num_tokens,
         round(CAST(logs->>'$."eval_rewards/chosen"' AS DOUBLE), 4) AS rewards_chosen,
         round(CAST(logs->>'$."rewards/margins"' AS DOUBLE), 4) AS rewards_margins,
         round(CAST(logs->>'$.eval_nll_loss' AS DOUBLE), 4) AS eval_nll_loss
  FROM fx_trainer_raw WHERE logs NOT LIKE '%train_runtime%'"""


@query("a03_log_sink", with_views("fx_trainer_raw", NORMALISED_SQL))
def a03(spark, folder):
    path = append_log(records.normalised(raw_records(spark, folder)), new_path(spark, "log"))
    return read_back(spark, path)


@query("a03_raw_log", with_views("fx_trainer_raw", "SELECT run_id, logs AS line FROM fx_trainer_raw"))
def a03_raw(spark, folder):
    return read_log(spark, append_raw_log(raw_records(spark, folder), new_path(spark, "raw-log")))


@query(
    "a04_log_source",
    with_views(
        "fx_train_log",
        """SELECT run_id, line_no, CASE WHEN line = '' THEN 'blank' WHEN json_valid(line) THEN 'good' ELSE 'bad' END AS status,
                  CASE WHEN line <> '' AND NOT json_valid(line) THEN substr(line, 1, 50) END AS preview
           FROM fx_train_log""",
    ),
)
def a04(spark, folder):
    lines = records.parsed_lines(train_log(spark, folder))
    return lines.select("run_id", "line_no", "status", "preview")


def log_files(spark, folder):
    """The whole log, blank and broken lines among the good ones, as files of lines in order."""
    return append_raw_log(train_log(spark, folder), new_path(spark, "log-files"), logs="line", order="line_no")


@query(
    "a04_log_files",
    with_views(
        "fx_train_log",
        """SELECT run_id, line_no - 1 AS line_no, CASE WHEN line = '' THEN 'blank' WHEN json_valid(line) THEN 'good' ELSE 'bad' END AS status,
                  CASE WHEN line <> '' AND NOT json_valid(line) THEN line END AS bad_line
           FROM fx_train_log""",
    ),
)
def a04_files(spark, folder):
    """Every line of log files with its number, broken ones whole."""
    lines = records.parsed_lines(numbered_log(spark, log_files(spark, folder)))
    return lines.select("run_id", "line_no", "status", "bad_line")


WIDE_SQL = """SELECT run_id, line_no, CAST(line->>'$.epoch' AS DOUBLE) AS epoch, CAST(line->>'$.loss' AS DOUBLE) AS loss,
         CAST(line->>'$.grad_norm' AS DOUBLE) AS grad_norm, CAST(line->>'$.learning_rate' AS DOUBLE) AS learning_rate,
         CAST(line->>'$."rewards/accuracies"' AS DOUBLE) AS rewards_accuracies FROM good_log"""


def wide(parsed):
    return records.wide_view(parsed).withColumnRenamed("rewards/accuracies", "rewards_accuracies")


REPAIRED_SQL = """(SELECT run_id, line_no, CASE WHEN line = '' OR NOT json_valid(line) THEN '{}' ELSE line END AS line FROM fx_train_log)"""


@query("a05_strict_log_source", with_views("fx_train_log", WIDE_SQL.replace("good_log", REPAIRED_SQL)))
def a05(spark, folder):
    # strict reading must fail on the broken lines of the shared log (see tests), so they are mended to empty records
    line = F.coalesce(F.when(records.json_object(F.col("line")).isNotNull(), F.col("line")), F.lit("{}"))
    return wide(records.strict_records(train_log(spark, folder).withColumn("line", line)))


@query(
    "a05_strict_log_files",
    with_views(
        "fx_trainer_raw",
        f"""SELECT run_id, epoch, loss, grad_norm, learning_rate, CAST(NULL AS DOUBLE) AS rewards_accuracies
            FROM ({NORMALISED_SQL})""",
    ),
)
def a05_files(spark, folder):
    """Every line of a written log, read strictly."""
    path = append_log(records.normalised(raw_records(spark, folder)), new_path(spark, "strict-log"))
    return wide(records.strict_records(numbered_log(spark, path))).drop("line_no")


#: Entries of the listing that stand on disk at a time, about, and tasks that write them.
STANDING, TASKS = 100_000, 32


def stored_checkpoints(spark, folder, standing=STANDING):
    """Checkpoint folders written for the listing, a state file in each, and read back.

    A folder and its file take two blocks of disk, however small they are, and in a store that is not local the driver
    holds the status of each file.  So about ``standing`` entries are written at a time, what is found of them is stored,
    and the next ones take their places under the same root.
    """
    listing = checkpoint_listing(spark, folder)
    rounds = max(1, ceil(listing.count() / standing))
    number = F.pmod(F.xxhash64("run_id", "path"), F.lit(rounds)).cast("int")
    stored = new_path(spark, "checkpoint-entries")
    entries = checkpoint_entries(listing).withColumn("round", number)
    entries.repartition(rounds, "round").write.partitionBy("round").parquet(stored)
    entries = spark.read.schema(entries.schema).parquet(stored)
    root, found = new_path(spark, "checkpoints"), new_path(spark, "checkpoint-folders")
    schema = "run_id long, path string, is_dir boolean"
    spark.createDataFrame([], schema).write.parquet(f"{found}/round=-1")
    former = None
    for r in entries.select("round").distinct().orderBy("round").collect():
        mine = entries.where(F.col("round") == r["round"]).drop("round")
        write_checkpoints(mine, root, former, TASKS)
        checkpoint_folders(spark, root).write.parquet(f"{found}/round={r['round']}")
        former = mine
    if former is not None:
        remove_checkpoints(former, root)
        removed(spark, root)
    return spark.read.schema(schema).parquet(found)


CHECKPOINTS_SQL = r"""
  SELECT run_id, path, CAST(regexp_extract(path, '/checkpoint-([0-9]+)', 1) AS BIGINT) AS step, eval_loss
  FROM fx_checkpoints WHERE is_dir AND regexp_matches(path, '/checkpoint-[0-9]+')"""


@query("a08_checkpoint_scan", with_views("fx_checkpoints", CHECKPOINTS_SQL))
def a08(spark, folder):
    found = checkpoints.checkpoints(checkpoint_listing(spark, folder))
    return found.select("run_id", "path", F.col("step").cast("long").alias("step"), "eval_loss")


@query(
    "a08_checkpoint_folders",
    with_views("fx_checkpoints", f"SELECT DISTINCT run_id, path, step FROM ({CHECKPOINTS_SQL})"),
)
def a08_folders(spark, folder):
    """The listing of folders that hold a file for each checkpoint."""
    found = checkpoints.checkpoints(stored_checkpoints(spark, folder))
    name = F.concat(F.lit("runs/"), F.substring_index("path", "/", -1))
    return found.select("run_id", name.alias("path"), F.col("step").cast("long").alias("step"))


@query(
    "i08_latest_from_folders",
    with_views("fx_checkpoints", f"SELECT run_id, arg_max(path, step) AS path FROM ({CHECKPOINTS_SQL}) GROUP BY run_id"),
)
def i08_folders(spark, folder):
    newest = checkpoints.latest_checkpoint(stored_checkpoints(spark, folder))
    return newest.select("run_id", F.concat(F.lit("runs/"), F.substring_index("path", "/", -1)).alias("path"))


@query(
    "b19_record_routing",
    with_views(
        "fx_trainer_raw",
        """SELECT run_id, step, CASE WHEN logs LIKE '%"train_runtime"%' THEN 'dropped'
                  WHEN logs LIKE '%"eval_loss"%' THEN 'eval' ELSE 'step' END AS kind FROM fx_trainer_raw""",
    ),
)
def b19(spark, folder):
    kind = records.record_kind(records.json_object(F.col("logs")))
    return raw_records(spark, folder).select(
        "run_id", "step", F.coalesce(kind, F.lit("dropped")).alias("kind")
    )


@query(
    "b20_unpivot",
    with_views("log_values", "SELECT run_id, line_no, series, step, epoch, metric, round(value, 6) AS value FROM log_values"),
)
def b20(spark, folder):
    return log_values(spark, folder).withColumn("value", F.round("value", 6))


def resolution_sql(requested, sampled="log_values"):
    names = ", ".join(f"'{m}'" for m in requested)
    return f"""
      SELECT run_id, place, requested, 'train' AS series, requested AS metric
      FROM (SELECT unnest([{names}]) AS requested, unnest(range({len(requested)})) AS place)
      JOIN (SELECT DISTINCT run_id, metric FROM {sampled} WHERE series = 'train') ON metric = requested
      UNION ALL
      SELECT run_id, place, requested, 'eval' AS series, coalesce(max(metric) FILTER (metric = prefixed), max(metric)) AS metric
      FROM (SELECT *, CASE WHEN requested LIKE 'eval\\_%' ESCAPE '\\' THEN requested ELSE 'eval_' || requested END AS prefixed
            FROM (SELECT unnest([{names}]) AS requested, unnest(range({len(requested)})) AS place))
      JOIN (SELECT DISTINCT run_id, metric FROM {sampled} WHERE series = 'eval') ON metric IN (requested, prefixed)
      GROUP BY run_id, place, requested"""


@query(
    "d05_metric_resolution",
    with_views("log_values", resolution_sql(CURVE_METRICS).replace("\\\\", "\\")),
)
def d05(spark, folder):
    available = written(records.metric_sizes(log_values(spark, folder)), "metric-sizes")
    found = series.resolved_metrics(available, CURVE_METRICS, dedup=False)
    return found.select("run_id", "place", "requested", "series", "metric")


@query(
    "l02_merged_series",
    with_views(
        "log_values",
        f"SELECT DISTINCT run_id, series, metric FROM ({resolution_sql(CURVE_METRICS)})".replace("\\\\", "\\"),
    ),
)
def l02(spark, folder):
    available = written(records.metric_sizes(log_values(spark, folder)), "metric-sizes")
    return series.resolved_metrics(available, CURVE_METRICS).select("run_id", "series", "metric")


@query(
    "h07_metric_lists",
    with_views(
        "log_values",
        "\nUNION ALL\n".join(
            f"SELECT '{kind}' AS training_type, run_id, series, metric FROM (SELECT DISTINCT run_id, series, metric FROM ({resolution_sql(names)}))"
            for kind, names in records.METRICS_TO_PLOT.items()
        ).replace("\\\\", "\\"),
    ),
)
def h07(spark, folder):
    available = written(records.metric_sizes(log_values(spark, folder)), "metric-sizes")
    parts = [
        series.resolved_metrics(available, names).select(
            F.lit(kind).alias("training_type"), "run_id", "series", "metric"
        )
        for kind, names in records.METRICS_TO_PLOT.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "e04_training_loss",
    with_views(
        "log_values",
        """SELECT run_id, min(value) AS best_loss, arg_max(value, line_no) AS final_loss
           FROM log_values WHERE series = 'train' AND metric = 'loss' GROUP BY run_id""",
    ),
)
def e04(spark, folder):
    return records.run_losses(log_series(spark, folder))


@query(
    "e05_run_extent",
    with_views(
        "log_series",
        "SELECT run_id, max(epoch) AS max_epoch, max(step) AS max_step FROM log_series WHERE series = 'train' GROUP BY run_id",
    ),
)
def e05(spark, folder):
    return records.run_extent(log_series(spark, folder))


@query(
    "e06_eval_loss",
    with_views(
        "log_values",
        """SELECT run_id, min(value) AS best_eval_loss, arg_max(value, line_no) AS final_eval_loss
           FROM log_values WHERE series = 'eval' AND metric = 'eval_loss' GROUP BY run_id""",
    ),
)
def e06(spark, folder):
    return records.run_eval_losses(log_series(spark, folder))


SUMMARY_SQL = """SELECT run_id, max(step) FILTER (kind <> 'summary') AS total_steps,
                  max(epoch) FILTER (kind <> 'summary') AS total_epochs,
                  min(CAST(line->>'$.eval_loss' AS DOUBLE)) FILTER (kind = 'eval') AS best_metric,
                  bool_or(kind = 'summary') AS training_completed
           FROM good_log GROUP BY run_id"""


@query("e07_run_summary", with_views("good_log", SUMMARY_SQL))
def e07(spark, folder):
    return records.run_summaries(good(spark, folder))


@query("a03_closing_summaries", with_views("good_log", f"SELECT * FROM ({SUMMARY_SQL}) WHERE training_completed"))
def a03_summaries(spark, folder):
    """Closing records written to the logs of finished runs and read back as typed columns."""
    path = append_summaries(records.run_summaries(good(spark, folder)), new_path(spark, "summaries"))
    shape = "total_steps long, total_epochs double, best_metric double, training_completed boolean"
    return read_log(spark, path).select("run_id", F.from_json("line", shape).alias("s")).select("run_id", "s.*")


def _extremes(series, metric):
    chosen = f"FILTER (series = '{series}' AND metric = '{metric}')"
    return f"min(value) {chosen} AS best_{metric}, arg_max(value, line_no) {chosen} AS final_{metric}"


@query(
    "e07_training_summary",
    with_views(
        "log_series log_values",
        f"""SELECT * FROM (SELECT run_id, max(epoch) FILTER (series = 'train') AS max_epoch, max(step) FILTER (series = 'train') AS max_step
                           FROM log_series GROUP BY run_id)
            JOIN (SELECT run_id, {_extremes("train", "loss")}, {_extremes("eval", "eval_loss")}
                  FROM log_values GROUP BY run_id) USING (run_id)""",
    ),
)
def e07_training(spark, folder):
    return curves.training_summary(train_log(spark, folder))


@query(
    "e08_series_points",
    with_views("log_values", "SELECT run_id, series, metric, count(*) AS points FROM log_values GROUP BY ALL"),
)
def e08(spark, folder):
    return records.metric_sizes(log_values(spark, folder))


def normalised_columns(spark, folder, kind, *metrics):
    rows = records.normalised(raw_records(spark, folder)).where(F.col("type") == kind)
    return rows.select(
        "run_id",
        "step",
        "epoch",
        *[records.number(F.col("metrics"), m).alias(m.replace("/", "_")) for m in metrics],
    )


@query(
    "h01_eval_record",
    with_views(
        "fx_trainer_raw",
        f"""SELECT run_id, step, epoch, eval_loss, eval_runtime, rewards_chosen, eval_nll_loss
            FROM ({NORMALISED_SQL}) WHERE type = 'eval'""",
    ),
)
def h01(spark, folder):
    return normalised_columns(spark, folder, "eval", "eval_loss", "eval_runtime", "rewards/chosen", "eval_nll_loss")


@query(
    "h02_reward_renaming",
    with_views(
        "fx_trainer_raw",
        """SELECT run_id, step, CASE WHEN key LIKE 'eval_rewards/%' THEN replace(key, 'eval_', '') ELSE key END AS metric
           FROM (SELECT run_id, step, unnest(json_keys(logs)) AS key FROM fx_trainer_raw
                 WHERE logs LIKE '%"eval_loss"%') WHERE key <> 'epoch'""",
    ),
)
def h02(spark, folder):
    kept = records.normalised(raw_records(spark, folder), keep_all=True).where(F.col("type") == "eval")
    return kept.select("run_id", "step", F.explode(F.map_keys("metrics")).alias("metric"))


@query(
    "h03_step_record",
    with_views(
        "fx_trainer_raw",
        f"""SELECT run_id, step, epoch, loss, learning_rate, grad_norm, num_tokens, rewards_margins
            FROM ({NORMALISED_SQL}) WHERE type = 'step'""",
    ),
)
def h03(spark, folder):
    return normalised_columns(spark, folder, "step", "loss", "learning_rate", "grad_norm", "num_tokens", "rewards/margins")


@query(
    "h04_missing_defaults",
    with_views(
        "fx_trainer_raw",
        """SELECT run_id, step, coalesce(CAST(logs->>'$.epoch' AS DOUBLE), 0) AS epoch,
                  coalesce(CAST(logs->>'$.loss' AS DOUBLE), 0) AS loss,
                  coalesce(CAST(logs->>'$.eval_loss' AS DOUBLE), 0) AS eval_loss,
                  coalesce(CAST(logs->>'$.learning_rate' AS DOUBLE), 0) AS learning_rate
           FROM fx_trainer_raw""",
    ),
)
def h04(spark, folder):
    parsed = raw_records(spark, folder).withColumn("record", records.json_object(F.col("logs")))
    return parsed.select(
        "run_id",
        "step",
        *[
            records.number(F.col("record"), key, 0.0).alias(key)
            for key in ("epoch", "loss", "eval_loss", "learning_rate")
        ],
    )


@query(
    "h05_series_split",
    with_views("log_series", "SELECT run_id, line_no, series, step, epoch FROM log_series"),
)
def h05(spark, folder):
    return log_series(spark, folder).drop("record")


@query("h06_wide_view", with_views("good_log", WIDE_SQL))
def h06(spark, folder):
    return wide(good(spark, folder))


def smoothed_query(name, method, window, sql):
    @query(name, sql)
    def smooth(spark, folder):
        # placing and smoothing read the values twice: parse the log once
        values = written(log_values(spark, folder), "log-values")
        out = smoothing.smoothed(values, method, window)
        return rounded(out, "smoothed", keep=["run_id", "series", "metric", "line_no"])


smoothed_query(
    "i01_moving_average",
    "moving_average",
    WINDOW,
    with_views(
        "log_values_placed",
        """SELECT run_id, series, metric, line_no, round(CASE WHEN n <= 10 THEN value WHEN pos >= 9 THEN
                  avg(value) OVER (PARTITION BY run_id, series, metric ORDER BY line_no
                                   ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END, 6) AS smoothed
           FROM log_values_placed""",
    ),
)
smoothed_query(
    "i02_exponential_average",
    "exponential",
    WINDOW,
    with_views(
        "log_values_placed",
        """, placed AS MATERIALIZED (SELECT * FROM log_values_placed),
        chain AS (
          WITH RECURSIVE walk AS (
            SELECT run_id, series, metric, line_no, pos, n, value, value AS s FROM placed WHERE pos = 0
            UNION ALL
            SELECT p.run_id, p.series, p.metric, p.line_no, p.pos, p.n, p.value,
                   p.value * (2.0::DOUBLE / 11) + (1 - 2.0::DOUBLE / 11) * w.s
            FROM walk w JOIN placed p ON p.run_id = w.run_id AND p.series = w.series
              AND p.metric = w.metric AND p.pos = w.pos + 1)
          SELECT * FROM walk)
        SELECT run_id, series, metric, line_no, round(CASE WHEN n <= 10 THEN value ELSE s END, 6) AS smoothed
        FROM chain""",
    ),
)
smoothed_query(
    "i03_savgol",
    "savgol",
    SAVGOL_WINDOW,
    with_views(
        "log_values_placed",
        """, starts AS (
          SELECT *, greatest(0, least(pos - 5, n - 11)) AS ws FROM log_values_placed)
        SELECT s.run_id, s.series, s.metric, s.line_no, round(CASE WHEN any_value(s.n) <= 12 THEN any_value(s.value)
          ELSE sum(v.value * (CAST(1 AS DOUBLE) / 11
            + (s.pos - s.ws - 5) * (v.pos - s.ws - 5) / CAST(110 AS DOUBLE)
            + ((s.pos - s.ws - 5) * (s.pos - s.ws - 5) - 10) * ((v.pos - s.ws - 5) * (v.pos - s.ws - 5) - 10)
              / CAST(858 AS DOUBLE))) END, 6) AS smoothed
        FROM starts s JOIN log_values_placed v ON v.run_id = s.run_id AND v.series = s.series
          AND v.metric = s.metric AND v.pos BETWEEN s.ws AND s.ws + 10
        GROUP BY s.run_id, s.series, s.metric, s.line_no""",
    ),
)

SAMPLED = ["run_id", "series", "line_no", "step"]


@query(
    "i05_downsample",
    with_views(
        "log_series_placed",
        "SELECT run_id, series, line_no, step FROM log_series_placed WHERE pos % 5 = 0",
    ),
)
def i05(spark, folder):
    return series.every_kth(log_series(spark, folder), FACTOR, series.RUN_SERIES).select(*SAMPLED)


AUTO_POINTS = 100


@query(
    "i06_auto_downsample",
    with_views(
        "log_series_placed",
        """SELECT run_id, series, line_no, step FROM log_series_placed WHERE series = 'train'
           AND pos % CASE WHEN n > 100 THEN greatest(1, n // 100) ELSE 1 END = 0""",
    ),
)
def i06(spark, folder):
    kept = series.downsampled(log_series(spark, folder), max_points=AUTO_POINTS)
    return kept.where(F.col("series") == "train").select(*SAMPLED)


@query(
    "i07_eval_downsample",
    with_views(
        "log_series_placed",
        """, t AS (SELECT run_id, CASE WHEN max(n) > 100 THEN greatest(1, max(n) // 100) END AS k
                  FROM log_series_placed WHERE series = 'train' GROUP BY run_id)
           SELECT run_id, series, line_no, step FROM log_series_placed JOIN t USING (run_id) WHERE series = 'eval'
           AND pos % CASE WHEN k IS NOT NULL THEN greatest(1, k // 2)
                          WHEN n > 25 THEN greatest(1, n // 25) ELSE 1 END = 0""",
    ),
)
def i07(spark, folder):
    kept = series.downsampled(log_series(spark, folder), max_points=AUTO_POINTS)
    return kept.where(F.col("series") == "eval").select(*SAMPLED)


@query(
    "i08_latest_checkpoint",
    with_views("fx_checkpoints", f"SELECT run_id, arg_max(path, step) AS path FROM ({CHECKPOINTS_SQL}) GROUP BY run_id"),
)
def i08(spark, folder):
    return checkpoints.latest_checkpoint(checkpoint_listing(spark, folder))


@query(
    "i09_best_checkpoint",
    with_views(
        "log_values",
        """SELECT run_id, step AS best_step, value AS best_eval_loss FROM log_values
           WHERE series = 'eval' AND metric = 'eval_loss'
           QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1""",
    ),
)
def i09(spark, folder):
    return records.best_eval_step(log_series(spark, folder))


@query(
    "i10_retention",
    with_views(
        "fx_checkpoints",
        f"""SELECT run_id, path FROM ({CHECKPOINTS_SQL})
            QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) <= 3
              OR row_number() OVER (PARTITION BY run_id ORDER BY eval_loss, step) = 1""",
    ),
)
def i10(spark, folder):
    return checkpoints.retained(checkpoint_listing(spark, folder))


def curves_sql(requested):
    return with_views(
        "log_series_placed log_values",
        f""", sampled AS (
          SELECT v.* FROM log_values v JOIN log_series_placed p USING (run_id, series, line_no)
          WHERE p.pos % CASE WHEN series = 'train' THEN 5 ELSE 2 END = 0),
        wanted AS (SELECT DISTINCT run_id, series, metric FROM ({resolution_sql(requested, "sampled")})),
        placed AS (
          SELECT s.*, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY run_id, series, metric) AS n,
                 avg(value) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS mean
          FROM sampled s JOIN wanted USING (run_id, series, metric)
          WINDOW w AS (PARTITION BY run_id, series, metric ORDER BY line_no))
        SELECT run_id, series, metric,
               CASE WHEN series = 'eval' AND NOT starts_with(metric, 'eval_') THEN 'eval_' || metric ELSE metric END AS label,
               step, epoch AS x, round(value, 6) AS raw,
               round(CASE WHEN series = 'train' AND n <= 10 THEN value WHEN series = 'train' AND pos >= 9 THEN mean END, 6) AS smoothed
        FROM placed""".replace("\\\\", "\\"),
    )


def curve_points(lines, requested):
    points = curves.curve_table(lines, requested, WINDOW, FACTOR)
    return rounded(points, "raw", "smoothed", keep=["run_id", "series", "metric", "label", "step", "x"])


@query("i11_curve_table", curves_sql(CURVE_METRICS))
def i11(spark, folder):
    return curve_points(train_log(spark, folder), CURVE_METRICS)


@query("i11_eval_only_curves", curves_sql(["eval_loss"]))
def i11_eval_only(spark, folder):
    return curve_points(train_log(spark, folder), ["eval_loss"])


@query("i11_curves_from_files", curves_sql(CURVE_METRICS))
def i11_files(spark, folder):
    """From log files, bad and blank lines among them, to curves."""
    return curve_points(numbered_log(spark, log_files(spark, folder)), CURVE_METRICS)


DPO_SQL = """
  SELECT *, rc - rr AS margin, CASE WHEN rc > rr THEN 1.0::DOUBLE ELSE 0 END AS hit FROM (
    SELECT 0.1::DOUBLE * (policy_chosen_logp - ref_chosen_logp) AS rc,
           0.1::DOUBLE * (policy_rejected_logp - ref_rejected_logp) AS rr FROM fx_pair_logps)"""


@query(
    "j01_dpo_metrics",
    with_views(
        "fx_pair_logps",
        f"""SELECT round(avg(-ln(1 / (1 + exp(-margin)))), 6) AS loss, round(avg(rc), 6) AS rewards_chosen,
                   round(avg(rr), 6) AS rewards_rejected, round(avg(hit), 6) AS rewards_accuracies,
                   round(avg(margin), 6) AS rewards_margins FROM ({DPO_SQL})""",
    ),
)
def j01(spark, folder):
    found = objectives.means(objectives.dpo_pairs(pair_logps(spark, folder)), objectives.DPO_METRICS)
    return rounded(found, *objectives.DPO_METRICS)


@query(
    "j02_orpo_metrics",
    with_views(
        "fx_pair_logps",
        """SELECT round(avg(-c + 0.1::DOUBLE * -ln(1 / (1 + exp(-lo)))), 6) AS loss, round(avg(-c), 6) AS nll_loss,
                  round(avg(-ln(1 / (1 + exp(-lo)))), 6) AS odds_ratio_loss, round(avg(lo), 6) AS log_odds,
                  round(avg(0.1::DOUBLE * c), 6) AS rewards_chosen, round(avg(0.1::DOUBLE * r), 6) AS rewards_rejected,
                  round(avg(CASE WHEN 0.1::DOUBLE * c > 0.1::DOUBLE * r THEN 1.0::DOUBLE ELSE 0 END), 6) AS rewards_accuracies,
                  round(avg(0.1::DOUBLE * c - 0.1::DOUBLE * r), 6) AS rewards_margins
           FROM (SELECT *, (c - r) - (ln(1 - exp(c)) - ln(1 - exp(r))) AS lo FROM (
             SELECT policy_chosen_logp / n_chosen_tokens AS c, policy_rejected_logp / n_rejected_tokens AS r
             FROM fx_pair_logps))""",
    ),
)
def j02(spark, folder):
    found = objectives.means(objectives.orpo_pairs(pair_logps(spark, folder)), objectives.ORPO_METRICS)
    return rounded(found, *objectives.ORPO_METRICS)


@query(
    "j03_token_metrics",
    with_views(
        "fx_token_scores",
        """SELECT count(*) AS num_tokens, round(avg(CASE WHEN argmax_id = label_id THEN 1.0::DOUBLE ELSE 0 END), 6) AS mean_token_accuracy,
                  round(-avg(label_logp), 6) AS nll_loss FROM fx_token_scores WHERE label_id <> -100""",
    ),
)
def j03(spark, folder):
    found = objectives.token_metrics(token_scores(spark, folder))
    return rounded(found, "mean_token_accuracy", "nll_loss", keep=["num_tokens"])


@query(
    "j04_side_means",
    with_views(
        "fx_pair_logps",
        """SELECT n_chosen_tokens, round(avg(policy_chosen_logp), 6) AS logps_chosen,
                  round(avg(policy_rejected_logp), 6) AS logps_rejected FROM fx_pair_logps GROUP BY n_chosen_tokens""",
    ),
)
def j04(spark, folder):
    found = objectives.side_means(pair_logps(spark, folder), "n_chosen_tokens")
    return rounded(found, "logps/chosen", "logps/rejected", keep=["n_chosen_tokens"])


@query(
    "j04_side_logits",
    with_views(
        "fx_pair_logps",
        """SELECT n_chosen_tokens, round(avg(policy_chosen_logp), 6) AS logps_chosen, round(avg(policy_rejected_logp), 6) AS logps_rejected,
                  round(avg(chosen_logit), 6) AS logits_chosen, round(avg(rejected_logit), 6) AS logits_rejected
           FROM fx_pair_logps GROUP BY n_chosen_tokens""",
    ),
)
def j04_logits(spark, folder):
    found = objectives.side_means(pair_logps(spark, folder), "n_chosen_tokens", logits=True)
    return rounded(found, "logps/chosen", "logps/rejected", "logits/chosen", "logits/rejected", keep=["n_chosen_tokens"])


@query("k01_live_log", with_views("fx_trainer_raw", NORMALISED_SQL))
def k01(spark, folder):
    path = new_path(spark, "live-log")
    raw = trainer_raw(events_stream(spark, folder))
    live.start_log(raw, path, new_path(spark, "live-log-progress")).awaitTermination()
    return read_back(spark, path)


@query(
    "k02_live_summary",
    with_views(
        "fx_trainer_raw",
        """SELECT run_id, max(step) AS last_step, max(coalesce(CAST(logs->>'$.epoch' AS DOUBLE), 0)) AS last_epoch,
                  count(*) AS records, min(CAST(logs->>'$.eval_loss' AS DOUBLE)) AS best_eval_loss,
                  arg_min(step, (CAST(logs->>'$.eval_loss' AS DOUBLE), step)) FILTER (logs LIKE '%eval_loss%') AS best_step,
                  bool_or(logs LIKE '%train_runtime%') AS training_completed
           FROM fx_trainer_raw GROUP BY run_id""",
    ),
)
def k02(spark, folder):
    path = new_path(spark, "live-summary")
    raw = trainer_raw(events_stream(spark, folder))
    live.start_summary(raw, path, new_path(spark, "live-summary-progress")).awaitTermination()
    return live.current_summaries(spark, path)
