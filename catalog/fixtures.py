"""Input tables of the queries, derived from the shared tables.

Each table is defined twice: as SQL for the check (``VIEWS``), and here as Spark
tables that scale - row keys and step numbers come from bounded ranges, never from
one window over a whole table.
"""

from __future__ import annotations

import errno
import os
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.operators import chats
from tunetables.operators.ordering import with_position

MAX_LENGTH = 256  # every rejection reason occurs at this length
STATE = b"weights"  # of every checkpoint

VIEWS = {
    "fx_chat_idx": """
        SELECT conv_id, CAST(row_number() OVER (ORDER BY conv_id) - 1 AS BIGINT) AS idx
        FROM (SELECT DISTINCT conv_id FROM conversations) t""",
    "fx_prefs": """
        WITH base AS (
          SELECT i.idx, max(CASE WHEN c.turn = 0 THEN c.text END) AS prompt,
                 max(CASE WHEN c.turn = 1 THEN c.text END) AS answer
          FROM conversations c JOIN fx_chat_idx i ON c.conv_id = i.conv_id GROUP BY i.idx),
        n AS (SELECT count(*) AS n FROM base)
        SELECT a.idx, CASE WHEN a.idx % 5 = 0 THEN 'test_prefs' ELSE 'train_prefs' END AS split,
               a.prompt,
               CASE WHEN a.idx % 17 = 3 THEN '   ' ELSE a.answer END AS chosen,
               CASE WHEN a.idx % 19 = 5 THEN ' ' || a.answer || chr(10)
                    WHEN a.idx % 23 = 7 THEN 'No.' ELSE b.answer END AS rejected
        FROM base a CROSS JOIN n JOIN base b ON b.idx = (a.idx + 1) % n.n""",
    "fx_train_log": """
        WITH s AS (
          SELECT event_id, user_id % 4 AS run_id, event_type, value,
                 row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS step
          FROM events)
        SELECT run_id, CAST(step AS BIGINT) AS line_no,
          CASE WHEN event_id % 97 = 13 THEN '{"type":"step","st'
               WHEN event_id % 101 = 7 THEN ''
               WHEN event_id % 103 = 11 THEN '{"type":"summary","total_steps":' || CAST(step AS STRING)
                 || ',"total_epochs":1.0,"best_metric":null,"training_completed":true}'
               WHEN event_type = 'error' THEN '{"type":"eval","step":' || CAST(step AS STRING)
                 || ',"epoch":' || CAST(CAST(step AS DOUBLE) / 1000 AS STRING)
                 || ',"eval_loss":' || CAST(value AS STRING)
                 || ',"rewards/margins":' || CAST(value / 4 AS STRING) || '}'
               ELSE '{"type":"step","step":' || CAST(step AS STRING)
                 || ',"epoch":' || CAST(CAST(step AS DOUBLE) / 1000 AS STRING)
                 || ',"loss":' || CAST(value AS STRING) || ',"grad_norm":'
                 || CASE WHEN event_type = 'view' THEN 'null' ELSE CAST(value / 2 AS STRING) END || '}'
          END AS line
        FROM s""",
    "fx_pair_logps": """
        SELECT l_orderkey * 10 + l_linenumber AS pair_id, -l_quantity - 1 AS policy_chosen_logp,
               -l_quantity * (1 + l_discount) - 2 AS policy_rejected_logp,
               -l_quantity * (1 + l_tax) - 1 AS ref_chosen_logp,
               -l_quantity - 2 AS ref_rejected_logp,
               CAST(l_linenumber + 4 AS INT) AS n_chosen_tokens,
               CAST(l_linenumber + 6 AS INT) AS n_rejected_tokens,
               l_discount * 10 - l_linenumber AS chosen_logit, l_tax * 10 - l_linenumber AS rejected_logit
        FROM lineitem""",
    "fx_token_scores": """
        SELECT l_orderkey AS seq_id, l_linenumber AS pos,
               CASE WHEN l_returnflag = 'R' THEN -100 ELSE l_suppkey % 10 END AS label_id,
               l_partkey % 10 AS argmax_id, -l_discount * 10 - l_tax AS label_logp
        FROM lineitem""",
    "fx_token_embeddings": """
        SELECT CAST((vec_id - vec_id % 20) / 20 AS BIGINT) AS pair_id,
               CASE WHEN vec_id % 2 = 0 THEN 'pred' ELSE 'ref' END AS side,
               vec_id % 20 AS pos, embedding
        FROM embeddings""",
    "fx_checkpoints": """
        SELECT o_custkey % 20 AS run_id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'runs/final'
                    WHEN o_orderkey % 11 = 0 THEN 'runs/checkpoint-' || CAST(o_orderkey * 10 AS STRING) || '-old'
                    ELSE 'runs/checkpoint-' || CAST(o_orderkey * 10 AS STRING) END AS path,
               o_orderstatus <> 'P' AS is_dir, o_totalprice AS eval_loss
        FROM orders""",
    "fx_pairs": """
        SELECT a.doc_id AS pair_id, a.text AS prediction, b.text AS reference
        FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1
        WHERE a.doc_id % 2 = 0""",
    "fx_trainer_raw": """
        SELECT user_id % 4 AS run_id, event_id AS step,
          CASE WHEN event_id % 89 = 5 THEN '{"train_runtime":12.5,"train_loss":0.5}'
               WHEN event_type = 'error' THEN '{"epoch":0.123456,"eval_loss":' || CAST(value AS STRING)
                 || '371,"eval_runtime":3,"eval_rewards/chosen":-' || CAST(value AS STRING)
                 || '129,"eval_nll_loss":1.5}'
               ELSE '{"epoch":0.123456,"loss":' || CAST(value AS STRING)
                 || '371,"learning_rate":2e-4,"grad_norm":'
                 || CASE WHEN event_type = 'view' THEN '0.0' ELSE CAST(value AS STRING) || '58' END
                 || ',"num_tokens":512,"rewards/margins":' || CAST(value AS STRING) || '77}'
          END AS logs
        FROM events""",
    # token lists in the check's spelling of the token pattern
    "chat_lengths": r"""
        SELECT conv_id, CAST(sum(CASE WHEN role IN ('user', 'assistant') THEN
                 len(regexp_extract_all('### ' || CASE role WHEN 'user' THEN 'User' ELSE 'Assistant' END
                   || ':' || chr(10) || text || chr(10), '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]'))
                 ELSE 0 END) AS BIGINT) AS length
        FROM conversations GROUP BY conv_id""",
    "chat_pieces": """
        SELECT conv_id, turn, role,
               CASE role WHEN 'user' THEN '### User:' || chr(10) || text || chr(10)
                         WHEN 'assistant' THEN '### Assistant:' || chr(10) || text || chr(10) END AS piece
        FROM conversations""",
    "chat_first": """
        SELECT conv_id, max(CASE WHEN turn = 0 THEN text END) AS prompt,
               max(CASE WHEN turn = 1 THEN text END) AS response
        FROM conversations GROUP BY conv_id""",
    "pair_lengths": r"""
        SELECT *,
          len(regexp_extract_all(prompt, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]')) AS prompt_len,
          len(regexp_extract_all(chosen, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]')) AS chosen_len,
          len(regexp_extract_all(rejected, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]')) AS rejected_len,
          regexp_replace(prompt, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') AS p,
          regexp_replace(chosen, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') AS c,
          regexp_replace(rejected, '^[\t-\r\x1c-\x20\x85\p{Z}]+|[\t-\r\x1c-\x20\x85\p{Z}]+$', '', 'g') AS r
        FROM fx_prefs""",
    "pair_reasons": """
        SELECT *, CASE WHEN p = '' OR c = '' OR r = '' THEN 'empty'
                       WHEN c = r THEN 'identical'
                       WHEN prompt_len + chosen_len > 256 * CAST(0.9 AS DOUBLE)
                         OR prompt_len + rejected_len > 256 * CAST(0.9 AS DOUBLE) THEN 'too_long'
                       WHEN chosen_len < 5 OR rejected_len < 5 THEN 'too_short' END AS reason
        FROM pair_lengths""",
    "doc_tokens": r"""
        SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS place
        FROM (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]') AS toks
              FROM documents)""",
    "doc_vocab": """
        SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) AS id
        FROM (SELECT token, count(*) AS freq FROM doc_tokens GROUP BY token)""",
    "doc_ids": """
        SELECT t.doc_id, t.place, v.id FROM doc_tokens t JOIN doc_vocab v ON v.token = t.token""",
    "chat_vocab": r"""
        SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) AS id
        FROM (SELECT token, count(*) AS freq
              FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]')) AS token
                    FROM conversations)
              GROUP BY token)""",
    "good_log": """
        SELECT run_id, line_no, line, line->>'$.type' AS kind,
               CASE WHEN line->>'$.type' = 'eval' THEN 'eval' ELSE 'train' END AS series,
               coalesce(CAST(line->>'$.step' AS BIGINT), 0) AS step,
               coalesce(CAST(line->>'$.epoch' AS DOUBLE), 0) AS epoch
        FROM fx_train_log WHERE CASE WHEN line = '' THEN false ELSE json_valid(line) END""",
    "log_series": """
        SELECT run_id, line_no, series, step, epoch, line FROM good_log WHERE kind <> 'summary'""",
    "log_values": """
        SELECT run_id, line_no, series, step, epoch, metric, value FROM (
          SELECT run_id, line_no, series, step, epoch, metric,
                 CAST(json_extract_string(line, '$."' || metric || '"') AS DOUBLE) AS value
          FROM (SELECT *, unnest(json_keys(line)) AS metric FROM log_series)
          WHERE metric NOT IN ('type', 'step', 'epoch'))
        WHERE value IS NOT NULL""",
    "log_values_placed": """
        SELECT *, row_number() OVER w - 1 AS pos,
               count(*) OVER (PARTITION BY run_id, series, metric) AS n
        FROM log_values WINDOW w AS (PARTITION BY run_id, series, metric ORDER BY line_no)""",
    "log_series_placed": """
        SELECT *, row_number() OVER (PARTITION BY run_id, series ORDER BY line_no) - 1 AS pos,
               count(*) OVER (PARTITION BY run_id, series) AS n
        FROM log_series""",
}

_NEEDS = {
    name: [other for other in VIEWS if other != name and other in text.replace('"', " ").split()]
    for name, text in ((n, t.replace("(", " ").replace(")", " ").replace(",", " ")) for n, t in VIEWS.items())
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the WITH clauses of the named views and what they read."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n" + body


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def prefs(spark: SparkSession, folder: str) -> DataFrame:
    """``fx_prefs``: flat pairs ``(idx, split, prompt, chosen, rejected)``."""
    base = with_position(chats.chat_rows(turns(spark, folder)), [], "conv_id", "idx", "total")
    here = base.select(
        "idx", "prompt", F.col("response").alias("answer"), ((F.col("idx") + 1) % F.col("total")).alias("next")
    )
    there = base.select(F.col("idx").alias("next"), F.col("response").alias("other"))
    idx = F.col("idx")
    return here.join(there, "next").select(
        "idx",
        F.when(idx % 5 == 0, "test_prefs").otherwise("train_prefs").alias("split"),
        "prompt",
        F.when(idx % 17 == 3, "   ").otherwise(F.col("answer")).alias("chosen"),
        F.when(idx % 19 == 5, F.concat(F.lit(" "), "answer", F.lit("\n")))
        .when(idx % 23 == 7, "No.")
        .otherwise(F.col("other"))
        .alias("rejected"),
    )


def preference_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs as rows of chats, the shape training sets are made from."""
    say = lambda role, text: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
    return prefs(spark, folder).select(
        "idx",
        "split",
        "prompt",
        F.array(say("user", "prompt"), say("assistant", "chosen")).alias("chosen"),
        F.array(say("user", "prompt"), say("assistant", "rejected")).alias("rejected"),
    )


def _text(value: Column) -> Column:
    return value.cast("string")


def train_log(spark: SparkSession, folder: str) -> DataFrame:
    """``fx_train_log``: log lines ``(run_id, line_no, line)`` of four runs."""
    events = table(spark, folder, "events").select(
        "event_id", (F.col("user_id") % 4).alias("run_id"), "event_type", "value"
    )
    placed = with_position(events, ["run_id"], "event_id").withColumn("step", F.col("pos") + 1)
    step, value, event = _text(F.col("step")), F.col("value"), F.col("event_id")
    epoch = _text(F.col("step").cast("double") / 1000)
    grad = F.when(F.col("event_type") == "view", "null").otherwise(_text(value / 2))
    line = (
        F.when(event % 97 == 13, '{"type":"step","st')
        .when(event % 101 == 7, "")
        .when(
            event % 103 == 11,
            F.concat(
                F.lit('{"type":"summary","total_steps":'),
                step,
                F.lit(',"total_epochs":1.0,"best_metric":null,"training_completed":true}'),
            ),
        )
        .when(
            F.col("event_type") == "error",
            F.concat(
                F.lit('{"type":"eval","step":'),
                step,
                F.lit(',"epoch":'),
                epoch,
                F.lit(',"eval_loss":'),
                _text(value),
                F.lit(',"rewards/margins":'),
                _text(value / 4),
                F.lit("}"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('{"type":"step","step":'),
                step,
                F.lit(',"epoch":'),
                epoch,
                F.lit(',"loss":'),
                _text(value),
                F.lit(',"grad_norm":'),
                grad,
                F.lit("}"),
            )
        )
    )
    return placed.select("run_id", F.col("step").alias("line_no"), line.alias("line"))


def trainer_raw(events: DataFrame) -> DataFrame:
    """``fx_trainer_raw`` from static or streaming events: ``(run_id, step, logs)``."""
    value, event = _text(F.col("value")), F.col("event_id")
    grad = F.when(F.col("event_type") == "view", "0.0").otherwise(F.concat(value, F.lit("58")))
    logs = (
        F.when(event % 89 == 5, '{"train_runtime":12.5,"train_loss":0.5}')
        .when(
            F.col("event_type") == "error",
            F.concat(
                F.lit('{"epoch":0.123456,"eval_loss":'),
                value,
                F.lit('371,"eval_runtime":3,"eval_rewards/chosen":-'),
                value,
                F.lit('129,"eval_nll_loss":1.5}'),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('{"epoch":0.123456,"loss":'),
                value,
                F.lit('371,"learning_rate":2e-4,"grad_norm":'),
                grad,
                F.lit(',"num_tokens":512,"rewards/margins":'),
                value,
                F.lit("77}"),
            )
        )
    )
    return events.select((F.col("user_id") % 4).alias("run_id"), F.col("event_id").alias("step"), logs.alias("logs"))


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, folder, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )


def pair_logps(spark: SparkSession, folder: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pair_id"),
        (-q - 1).alias("policy_chosen_logp"),
        (-q * (1 + F.col("l_discount")) - 2).alias("policy_rejected_logp"),
        (-q * (1 + F.col("l_tax")) - 1).alias("ref_chosen_logp"),
        (-q - 2).alias("ref_rejected_logp"),
        (F.col("l_linenumber") + 4).alias("n_chosen_tokens"),
        (F.col("l_linenumber") + 6).alias("n_rejected_tokens"),
        (F.col("l_discount") * 10 - F.col("l_linenumber")).alias("chosen_logit"),
        (F.col("l_tax") * 10 - F.col("l_linenumber")).alias("rejected_logit"),
    )


def token_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("seq_id"),
        F.col("l_linenumber").alias("pos"),
        F.when(F.col("l_returnflag") == "R", -100).otherwise(F.col("l_suppkey") % 10).alias("label_id"),
        (F.col("l_partkey") % 10).alias("argmax_id"),
        (-F.col("l_discount") * 10 - F.col("l_tax")).alias("label_logp"),
    )


def token_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    vec = F.col("vec_id")
    return table(spark, folder, "embeddings").select(
        F.floor(vec / 20).cast("long").alias("pair_id"),
        F.when(vec % 2 == 0, "pred").otherwise("ref").alias("side"),
        (vec % 20).alias("pos"),
        "embedding",
    )


def checkpoint_listing(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.concat(F.lit("runs/checkpoint-"), _text(key * 10))
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") % 20).alias("run_id"),
        F.when(key % 13 == 0, "runs/final")
        .when(key % 11 == 0, F.concat(name, F.lit("-old")))
        .otherwise(name)
        .alias("path"),
        (F.col("o_orderstatus") != "P").alias("is_dir"),
        F.col("o_totalprice").alias("eval_loss"),
    )


def checkpoint_entries(listing: DataFrame) -> DataFrame:
    """``run_id, path, is_dir`` of each name: it is a folder or a file, not both."""
    return listing.groupBy("run_id", "path").agg(F.bool_or("is_dir").alias("is_dir"))


def _renamed(former: dict, run: int, place: str) -> bool:
    """Whether one of a task's ``former`` places, of the same run if there is one, has got the name ``place``."""
    while former:
        of = run if run in former else next(iter(former))
        old = former[of].pop()
        if not former[of]:
            del former[of]
        try:
            os.rename(old, place)
        except FileNotFoundError:  # an earlier try of this task has renamed it
            continue
        except OSError as fault:
            if fault.errno not in (errno.ENOTEMPTY, errno.EEXIST):
                raise
            former.setdefault(of, []).append(old)  # an earlier try has filled the new place
        return True
    return False


def _save(former: dict, run: int, place: str, is_dir: bool) -> None:
    """A local entry with its state, in a former one's place if there is one."""
    if not _renamed(former, run, place) and is_dir:
        os.makedirs(place, exist_ok=True)
    out = os.open(f"{place}/state" if is_dir else place, os.O_WRONLY | os.O_CREAT)
    try:
        os.write(out, STATE)
    finally:
        os.close(out)


def _save_in(store, place: str, is_dir: bool) -> None:
    place += "/state" if is_dir else ""
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(place) as out:
        out.write(STATE)


def _remove_from(store, place: str, is_dir: bool) -> None:
    """What is gone already is no fault."""
    try:
        (store.delete_dir if is_dir else store.delete_file)(place)
    except FileNotFoundError:
        pass


def write_checkpoints(entries: DataFrame, root: str, former: DataFrame | None = None, tasks: int = 32) -> None:
    """Stand-in for trainers: ``<root>/run_id=<run>/<name>/state`` for folders, ``<root>/run_id=<run>/<name>`` for files.

    ``former`` entries, which were written before, go.  In a local file system a task renames as many of them as it needs
    to the new names and writes their states again, since to remove folders and make others takes it many times as long;
    in other stores, and where more are gone than come, they are removed.
    """

    def run(frames):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
        local, runs, left = isinstance(store, fs.LocalFileSystem), set(), {True: {}, False: {}}
        for frame in frames:
            for run, path, is_dir, new in zip(*(frame[c] for c in ("run_id", "path", "is_dir", "new")), strict=True):
                is_dir, place = bool(is_dir), f"{base}/run_id={run}/{path.split('/')[-1]}"
                if not new:
                    left[is_dir].setdefault(run, []).append(place)
                elif local:
                    if run not in runs:
                        os.makedirs(f"{base}/run_id={run}", exist_ok=True)
                        runs.add(run)
                    _save(left[is_dir], run, place, is_dir)
                else:
                    _save_in(store, place, is_dir)
            yield frame[["run_id"]]
        for is_dir, by_run in left.items():
            for place in chain.from_iterable(by_run.values()):
                _remove_from(store, place, is_dir)

    rows = entries.withColumn("new", F.lit(True))
    if former is not None:
        rows = former.withColumn("new", F.lit(False)).unionByName(rows)
    # a task gets about as many former entries as new ones, and those first
    rows = rows.repartition(tasks).sortWithinPartitions("new")
    rows.mapInPandas(run, "run_id long").write.format("noop").mode("overwrite").save()


def remove_checkpoints(entries: DataFrame, root: str) -> None:
    """Removes what ``write_checkpoints`` has written, in many tasks; what is gone already is no fault."""
    write_checkpoints(entries.limit(0), root, former=entries)


def text_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """``fx_pairs``, both sides keyed alike before the join so it is distributed by pair."""
    docs = documents(spark, folder)
    left = docs.where(F.col("doc_id") % 2 == 0).select(
        F.col("doc_id").alias("pair_id"), F.col("text").alias("prediction")
    )
    right = docs.where(F.col("doc_id") % 2 == 1).select(
        (F.col("doc_id") - 1).alias("pair_id"), F.col("text").alias("reference")
    )
    return left.repartition("pair_id").join(right.repartition("pair_id"), "pair_id")
