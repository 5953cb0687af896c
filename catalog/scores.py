"""Queries over predictions: generation, pairing, scores, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.fixtures import (
    preference_rows,
    prefs,
    text_pairs,
    token_embeddings,
    with_views,
)
from catalog.registry import query
from tunetables.functions import text as tx
from tunetables.operators import embedding_match, generation, ngrams, pairs, reports, rouge_lcs
from tunetables.operators.score_tables import POISSON_STEPS, bootstrap_scores, long_scores, mean_scores
from tunetables.plans import evaluation
from tunetables.session import new_path
from tunetables.sources.sinks import write_evaluation, write_examples, write_predictions


def load_stub():
    """A deterministic stand-in for a model."""
    return lambda prompts: [f"Answer to: {p} ({len(p)})" for p in prompts]


STUB_SQL = "'Answer to: ' || prompt || ' (' || length(prompt) || ')'"


def answers(spark, folder, rows=None):
    rows = preference_rows(spark, folder) if rows is None else rows
    return generation.generated(rows.select("idx", "prompt"), load_stub).select("idx", "prediction")


def rejected_as_predictions(spark, folder):
    return prefs(spark, folder).select("idx", F.col("rejected").alias("prediction"))


# --- the check's own word splitting and n-grams ---

def sides(pairs: str) -> str:
    return f"""
      SELECT pair_id, 'pred' AS side, prediction AS text FROM {pairs}
      UNION ALL SELECT pair_id, 'ref', reference FROM {pairs}"""


def bleu_words(pairs: str = "fx_pairs") -> str:
    return rf"""
      SELECT pair_id, side, list_filter(regexp_split_to_array(
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          ' ' || replace(replace(replace(replace(replace(replace(replace(text, '<skipped>', ''), '-' || chr(10), ''),
            chr(10), ' '), '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
          '([\{{-\~\[-\` -\&\(-\+\:-\@\/])', ' \1 ', 'g'),
          '([^0-9])([\.,])', '\1 \2 ', 'g'),
          '([\.,])([^0-9])', ' \1 \2', 'g'),
          '([0-9])(-)', '\1 \2 ', 'g'),
        '[\t-\r\x1c-\x20\x85\p{{Z}}]+'), lambda w: w <> '') AS words
      FROM ({sides(pairs)})"""


def rouge_words(pairs: str = "fx_pairs") -> str:
    return rf"""
      SELECT pair_id, side, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '),
        lambda w: w <> '') AS words
      FROM ({sides(pairs)})"""


def rouge_lines(pairs: str) -> str:
    """Words of the lines of each side that have any text."""
    return rf"""
      SELECT pair_id, side, line, list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS words
      FROM (SELECT pair_id, side, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line
            FROM ({sides(pairs)}))"""


def overlap_sql(words: str, max_n: int) -> str:
    return f"""
      SELECT pair_id, n, CAST(sum(least(cp, cr)) AS BIGINT) AS overlap, CAST(sum(cp) AS BIGINT) AS n_prediction,
             CAST(sum(cr) AS BIGINT) AS n_reference
      FROM (SELECT pair_id, n, gram, count(*) FILTER (side = 'pred') AS cp, count(*) FILTER (side = 'ref') AS cr
            FROM (SELECT pair_id, side, n, array_to_string(words[i:i + n - 1], ' ') AS gram
                  FROM (SELECT pair_id, side, words, n, unnest(range(1, len(words) - n + 2)) AS i
                        FROM ({words}), (SELECT unnest(range(1, {max_n + 1})) AS n)))
            GROUP BY pair_id, n, gram)
      GROUP BY pair_id, n"""


# every pair has some token in the shared tables, so no empty-pair rows arise here
@query("d03_clipped_ngrams", with_views("fx_pairs", overlap_sql(bleu_words(), 4)))
def d03(spark, folder):
    return ngrams.overlaps(text_pairs(spark, folder), tx.bleu_tokens, 4, clustered=True)


@query(
    "f01_bleu_tokens",
    with_views("fx_pairs", f"SELECT pair_id, side, array_to_string(words, ' ') AS words, len(words) AS n FROM ({bleu_words()})"),
)
def f01(spark, folder):
    both = F.array(
        F.struct(F.lit("pred").alias("side"), F.col("prediction").alias("text")),
        F.struct(F.lit("ref").alias("side"), F.col("reference").alias("text")),
    )
    sides = text_pairs(spark, folder).select("pair_id", F.inline(both))
    words = tx.bleu_tokens(F.col("text"))
    return sides.select(
        "pair_id", "side", F.array_join(words, " ").alias("words"), F.size(words).cast("long").alias("n")
    )


def bleu_sql(pairs: str = "fx_pairs") -> str:
    ratios = ", ".join(
        f"CAST(sum(overlap) FILTER (n = {n}) AS DOUBLE) / sum(n_prediction) FILTER (n = {n}) AS precision_{n}"
        for n in (1, 2, 3, 4)
    )
    return f"""
      SELECT *, CASE WHEN least(precision_1, precision_2, precision_3, precision_4) > 0
        THEN exp((ln(precision_1) + ln(precision_2) + ln(precision_3) + ln(precision_4)) / 4) * brevity_penalty
        ELSE 0 END AS bleu
      FROM (SELECT *, CASE WHEN length_ratio > 1 THEN 1 ELSE exp(1 - 1 / length_ratio) END AS brevity_penalty
        FROM (SELECT *, CAST(translation_length AS DOUBLE) / reference_length AS length_ratio
          FROM (SELECT {ratios},
                       CAST(sum(n_prediction) FILTER (n = 1) AS BIGINT) AS translation_length,
                       CAST(sum(n_reference) FILTER (n = 1) AS BIGINT) AS reference_length
                FROM ({overlap_sql(bleu_words(pairs), 4)}))))"""


BLEU_REALS = ["precision_1", "precision_2", "precision_3", "precision_4", "length_ratio", "brevity_penalty", "bleu"]


@query(
    "f02_corpus_bleu",
    with_views(
        "fx_pairs",
        f"SELECT translation_length, reference_length, {', '.join(f'round({c}, 6) AS {c}' for c in BLEU_REALS)} FROM ({bleu_sql()})",
    ),
)
def f02(spark, folder):
    score = ngrams.corpus_bleu(text_pairs(spark, folder), clustered=True)
    return score.select(
        "translation_length", "reference_length", *[F.round(c, 6).alias(c) for c in BLEU_REALS]
    )


def rouge_n_sql(pairs: str = "fx_pairs") -> str:
    return f"""
      SELECT pair_id, coalesce(max(f) FILTER (n = 1), 0) AS rouge1, coalesce(max(f) FILTER (n = 2), 0) AS rouge2
      FROM (SELECT pair_id, n, CAST(2.0 * overlap AS DOUBLE) / (n_prediction + n_reference) AS f
            FROM ({overlap_sql(rouge_words(pairs), 2)})) GROUP BY pair_id"""


@query(
    "f03_rouge_n",
    with_views("fx_pairs", f"SELECT pair_id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2 FROM ({rouge_n_sql()})"),
)
def f03(spark, folder):
    scores = ngrams.rouge_n(text_pairs(spark, folder), clustered=True)
    return scores.select("pair_id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


@query("f04_rouge_l")
def f04(spark, folder):
    scored = rouge_lcs.with_rouge_l(text_pairs(spark, folder))
    return scored.select("pair_id", F.round("rougeL", 6).alias("rougeL"))


def rouge_l_sql(pairs: str) -> str:
    """One step a candidate word; each keeps the whole row of subsequence lengths."""
    return f"""
      SELECT pair_id, CASE WHEN len(p) + len(r) > 0 THEN CAST(2.0 * row_[len(row_)] AS DOUBLE) / (len(p) + len(r)) ELSE 0 END AS rougeL
      FROM (
        WITH RECURSIVE walk AS (
          SELECT pair_id, p, r, CAST(0 AS BIGINT) AS i, list_transform(range(len(r) + 1), lambda j: CAST(0 AS BIGINT)) AS row_
          FROM (SELECT pair_id, any_value(words) FILTER (side = 'pred') AS p, any_value(words) FILTER (side = 'ref') AS r
                FROM ({rouge_words(pairs)}) GROUP BY pair_id)
          UNION ALL
          SELECT pair_id, p, r, i + 1,
                 list_reduce(list_prepend([CAST(0 AS BIGINT)], list_transform(range(1, len(r) + 1), lambda j: [j])),
                   lambda done, j: list_append(done,
                     CASE WHEN p[i + 1] = r[j[1]] THEN row_[j[1]] + 1 ELSE greatest(row_[j[1] + 1], done[len(done)]) END))
          FROM walk WHERE i < len(p))
        SELECT * FROM walk WHERE i = len(p))"""


ANSWER_PAIRS = "(SELECT idx AS pair_id, rejected AS prediction, chosen AS reference FROM fx_prefs)"


def answer_pairs(spark, folder):
    return prefs(spark, folder).select(
        F.col("idx").alias("pair_id"), F.col("rejected").alias("prediction"), F.col("chosen").alias("reference")
    )


@query(
    "f04_rouge_l_answers",
    with_views("fx_prefs", f"SELECT pair_id, round(rougeL, 6) AS rougeL FROM ({rouge_l_sql(ANSWER_PAIRS)})"),
)
def f04_answers(spark, folder):
    scored = rouge_lcs.with_rouge_l(answer_pairs(spark, folder))
    return scored.select("pair_id", F.round("rougeL", 6).alias("rougeL"))


@query(
    "f08_short_scores_answers",
    with_views(
        "fx_prefs",
        f"""SELECT 'bleu' AS metric, round(bleu, 6) AS value FROM ({bleu_sql(ANSWER_PAIRS)})
            UNION ALL SELECT 'rougeL', round(avg(rougeL), 6) FROM ({rouge_l_sql(ANSWER_PAIRS)})""",
    ),
)
def f08_short_answers(spark, folder):
    return short_scores(answer_pairs(spark, folder))


def rouge_lsum_sql(pairs: str) -> str:
    """Rows of subsequence lengths for each two lines, a walk back through them, and what the walks cover.

    ``line`` numbers lines of a side; a walk stands where the first ``i`` reference and ``j`` candidate words remain.
    """
    return f"""
      SELECT c.pair_id, CASE WHEN h.hits > 0 THEN 2.0::DOUBLE * h.hits / (c.n_p + c.n_r) ELSE 0 END AS rougeLsum
      FROM (SELECT pair_id, sum(len(words)) FILTER (side = 'pred') AS n_p, sum(len(words)) FILTER (side = 'ref') AS n_r
            FROM ({rouge_lines(pairs)}) GROUP BY pair_id) c
      LEFT JOIN (
        SELECT pair_id, sum(least(covered, there)) AS hits FROM (
          WITH RECURSIVE lines AS MATERIALIZED ({rouge_lines(pairs)}),
          both_ AS MATERIALIZED (
            SELECT r.pair_id, r.line AS s, p.line AS c, r.words AS r, p.words AS p
            FROM lines r JOIN lines p ON r.pair_id = p.pair_id AND r.side = 'ref' AND p.side = 'pred' AND list_has_any(r.words, p.words)),
          rows_ AS (
            SELECT pair_id, s, c, CAST(0 AS BIGINT) AS i, list_transform(range(len(p) + 1), lambda j: CAST(0 AS BIGINT)) AS row_, r, p FROM both_
            UNION ALL
            SELECT pair_id, s, c, i + 1,
                   list_reduce(list_prepend([CAST(0 AS BIGINT)], list_transform(range(1, len(p) + 1), lambda j: [j])),
                     lambda done, j: list_append(done,
                       CASE WHEN r[i + 1] = p[j[1]] THEN row_[j[1]] + 1 ELSE greatest(row_[j[1] + 1], done[len(done)]) END)), r, p
            FROM rows_ WHERE i < len(r)),
          kept_ AS MATERIALIZED (SELECT pair_id, s, c, i, row_ FROM rows_),
          walk AS (
            SELECT pair_id, s, c, r, p, CAST(len(r) AS BIGINT) AS i, CAST(len(p) AS BIGINT) AS j, CAST(NULL AS BIGINT) AS taken FROM both_
            UNION ALL
            SELECT w.pair_id, w.s, w.c, w.r, w.p,
                   CASE WHEN w.r[w.i] <> w.p[w.j] AND a.row_[w.j] > b.row_[w.j + 1] THEN w.i ELSE w.i - 1 END,
                   CASE WHEN w.r[w.i] = w.p[w.j] OR a.row_[w.j] > b.row_[w.j + 1] THEN w.j - 1 ELSE w.j END,
                   CASE WHEN w.r[w.i] = w.p[w.j] THEN w.i END
            FROM walk w JOIN kept_ a ON a.pair_id = w.pair_id AND a.s = w.s AND a.c = w.c AND a.i = w.i
                        JOIN kept_ b ON b.pair_id = w.pair_id AND b.s = w.s AND b.c = w.c AND b.i = w.i - 1
            WHERE w.i > 0 AND w.j > 0),
          covered AS (SELECT pair_id, w, count(*) AS covered
                      FROM (SELECT DISTINCT pair_id, s, taken, r[taken] AS w FROM walk WHERE taken IS NOT NULL) GROUP BY pair_id, w),
          there AS (SELECT pair_id, w, count(*) AS there FROM (SELECT pair_id, unnest(words) AS w FROM lines WHERE side = 'pred') GROUP BY pair_id, w)
          SELECT * FROM covered JOIN there USING (pair_id, w))
        GROUP BY pair_id) h ON h.pair_id = c.pair_id"""


@query(
    "f05_rouge_lsum_answers",
    with_views("fx_prefs", f"SELECT pair_id, round(rougeLsum, 6) AS rougeLsum FROM ({rouge_lsum_sql(ANSWER_PAIRS)})"),
)
def f05_answers(spark, folder):
    scored = rouge_lcs.with_rouge_lsum(answer_pairs(spark, folder))
    return scored.select("pair_id", F.round("rougeLsum", 6).alias("rougeLsum"))


@query("f05_rouge_lsum")
def f05(spark, folder):
    scored = rouge_lcs.with_rouge_lsum(text_pairs(spark, folder))
    return scored.select("pair_id", F.round("rougeLsum", 6).alias("rougeLsum"))


@query(
    "f06_rouge_corpus",
    with_views("fx_pairs", f"SELECT round(avg(rouge1), 6) AS rouge1, round(avg(rouge2), 6) AS rouge2 FROM ({rouge_n_sql()})"),
)
def f06(spark, folder):
    means = mean_scores(ngrams.rouge_n(text_pairs(spark, folder), clustered=True), ["rouge1", "rouge2"])
    return means.select(F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


def bootstrap_sql(scores: str, columns: list[str], resamples: int) -> str:
    """Every pair in every resample, with a weight from its own part of a hash."""
    weight = " + ".join(f"CAST(unit >= {step!r}::DOUBLE AS INT)" for step in POISSON_STEPS)
    figures = [
        f"round(quantile_cont({c}, {q}), 6) AS {c}{name}" for c in columns for name, q in (("_low", 0.025), ("", 0.5), ("_high", 0.975))
    ]
    return f"""
      SELECT {", ".join(figures)} FROM (
        SELECT b, {", ".join(f"sum({c} * w) / nullif(sum(w), 0) AS {c}" for c in columns)} FROM (
          SELECT *, {weight} AS w FROM (
            SELECT *, CAST(CAST('0x' || substr(md5(pair_id || ':' || (b // 4) || ':0'), CAST(8 * (b % 4) + 1 AS INT), 8) AS BIGINT) AS DOUBLE) / 4294967296 AS unit
            FROM ({scores}), (SELECT unnest(range({resamples})) AS b)))
        GROUP BY b)"""


@query("f06_bootstrap_rouge", with_views("fx_pairs", bootstrap_sql(rouge_n_sql(), ["rouge1", "rouge2"], 1000)))
def f06_bootstrap(spark, folder):
    scores = ngrams.rouge_n(text_pairs(spark, folder), clustered=True)
    found = bootstrap_scores(scores, ["rouge1", "rouge2"], confidence=0.95)
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


SIMILARITY_SQL = """
  SELECT p.pair_id, p.pos AS pred_pos, r.pos AS ref_pos,
         list_cosine_similarity(CAST(p.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS s
  FROM fx_token_embeddings p JOIN fx_token_embeddings r ON p.pair_id = r.pair_id AND p.side = 'pred' AND r.side = 'ref'"""
MATCH_SQL = f"""
  SELECT pair_id, 'pred' AS side, pred_pos AS pos, max(s) AS best FROM ({SIMILARITY_SQL}) GROUP BY pair_id, pred_pos
  UNION ALL
  SELECT pair_id, 'ref', ref_pos, max(s) FROM ({SIMILARITY_SQL}) GROUP BY pair_id, ref_pos"""
BERT_SQL = f"""
  SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM (
    SELECT pair_id, avg(best) FILTER (side = 'pred') AS precision, avg(best) FILTER (side = 'ref') AS recall
    FROM ({MATCH_SQL}) GROUP BY pair_id)"""


@query(
    "d04_greedy_match",
    with_views("fx_token_embeddings", f"SELECT pair_id, side, pos, round(best, 6) AS best FROM ({MATCH_SQL})"),
)
def d04(spark, folder):
    found = embedding_match.greedy_matches(token_embeddings(spark, folder))
    return found.withColumn("best", F.round("best", 6))


@query(
    "f07_bertscore",
    with_views(
        "fx_token_embeddings",
        f"SELECT pair_id, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({BERT_SQL})",
    ),
)
def f07(spark, folder):
    scores = embedding_match.embedding_scores(token_embeddings(spark, folder))
    return scores.select("pair_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "e09_average_score",
    with_views("fx_token_embeddings", f"SELECT round(avg(f1), 6) AS average_f1 FROM ({BERT_SQL})"),
)
def e09(spark, folder):
    scores = embedding_match.embedding_scores(token_embeddings(spark, folder))
    return mean_scores(scores, ["f1"]).select(F.round("f1", 6).alias("average_f1"))


@query(
    "f08_score_table",
    with_views(
        "fx_pairs fx_token_embeddings",
        f"""SELECT 'bleu' AS metric, round(bleu, 6) AS value FROM ({bleu_sql()})
            UNION ALL SELECT 'rouge1', round(avg(rouge1), 6) FROM ({rouge_n_sql()})
            UNION ALL SELECT 'bertscore', round(avg(f1), 6) FROM ({BERT_SQL})
            UNION ALL SELECT 'note', CAST(0 AS DOUBLE)""",
    ),
)
def f08(spark, folder):
    scored = text_pairs(spark, folder)
    rouge = mean_scores(ngrams.rouge_n(scored, clustered=True), ["rouge1"]).scalar()
    bert = mean_scores(embedding_match.embedding_scores(token_embeddings(spark, folder)), ["f1"])
    wide = ngrams.corpus_bleu(scored, clustered=True).select(
        "bleu", rouge.alias("rouge1"), bert.scalar().alias("bertscore"), F.lit("not a number").alias("note")
    )
    table = long_scores(wide, ["bleu", "rouge1", "bertscore", "note"])
    return table.withColumn("value", F.round("value", 6))


def short_scores(scored, clustered=False):
    rouge = mean_scores(rouge_lcs.with_rouge_l(scored), ["rougeL"]).scalar()
    wide = ngrams.corpus_bleu(scored, clustered=clustered).select("bleu", rouge.alias("rougeL"))
    return long_scores(wide, ["bleu", "rougeL"]).withColumn("value", F.round("value", 6))


@query("f08_short_scores")
def f08_short(spark, folder):
    return short_scores(text_pairs(spark, folder), clustered=True)


PREDICTIONS_SQL = with_views("fx_prefs", f"SELECT idx, {STUB_SQL} AS prediction FROM fx_prefs")


@query("g01_generation", PREDICTIONS_SQL)
def g01(spark, folder):
    return answers(spark, folder)


@query("g02_early_stop", PREDICTIONS_SQL + " WHERE idx < 12")
def g02(spark, folder):
    return answers(spark, folder, generation.early_rows(preference_rows(spark, folder)))


@query("l01_batches_in_order", PREDICTIONS_SQL)
def l01(spark, folder):
    rows = preference_rows(spark, folder)
    return generation.in_order(
        *[
            answers(spark, folder, rows.where(F.col("split") == split))
            for split in ("train_prefs", "test_prefs")
        ]
    )


@query(
    "d01_prediction_pairs",
    with_views("fx_prefs", "SELECT idx AS pair_id, rejected AS prediction, chosen AS reference FROM fx_prefs"),
)
def d01(spark, folder):
    references = pairs.references(preference_rows(spark, folder))
    return generation.paired(rejected_as_predictions(spark, folder), references)


def triples(spark, folder, n=None):
    rows = preference_rows(spark, folder)
    return reports.triples(rows, pairs.references(rows), rejected_as_predictions(spark, folder), n)


@query(
    "d02_triples",
    with_views("fx_prefs", "SELECT idx, prompt, chosen AS reference, rejected AS prediction FROM fx_prefs"),
)
def d02(spark, folder):
    return triples(spark, folder)


EXAMPLES_SQL = f"""SELECT idx, chr(10) || '--- Example ' || (idx + 1) || ' ---' || chr(10) || 'Prompt: ' || prompt || chr(10)
              || 'Reference (Chosen): ' || chosen || chr(10) || 'Model Prediction: ' || rejected || chr(10)
              || '{"-" * 30}' AS text FROM fx_prefs WHERE idx < 5"""


@query("i04_example_report", with_views("fx_prefs", EXAMPLES_SQL))
def i04(spark, folder):
    return reports.example_report(triples(spark, folder, 5), 5)


@query(
    "i04_example_file",
    with_views(
        "fx_prefs",
        f"""SELECT '{reports.EXAMPLES_HEADER}' AS line
            UNION ALL SELECT unnest(string_split(text, chr(10))) FROM ({EXAMPLES_SQL})""",
    ),
)
def i04_file(spark, folder):
    path = write_examples(triples(spark, folder, 5), new_path(spark, "examples"))
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


@query(
    "a07_predictions_sink",
    with_views(
        "fx_prefs",
        f"""SELECT unnest(string_split('Example ' || (idx + 1) || chr(10) || 'Prediction: ' || rejected || chr(10)
              || 'Reference: ' || chosen || chr(10) || '{"-" * 40}', chr(10))) AS line FROM fx_prefs""",
    ),
)
def a07(spark, folder):
    rows = triples(spark, folder).select("idx", "prediction", "reference")
    path = write_predictions(rows, new_path(spark, "predictions"))
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


DATASET = {"name": "conversations", "split": "test_prefs"}
MODEL = {"id": "stub", "device": "cpu"}


def evaluated(spark, folder):
    rows = preference_rows(spark, folder)
    scored = evaluation.predictions(rows, load_stub)
    return rows, scored, evaluation.corpus_metrics(scored, token_embeddings(spark, folder))


EVALUATED = f"(SELECT idx AS pair_id, {STUB_SQL} AS prediction, chosen AS reference FROM fx_prefs)"


@query(
    "f09_evaluation",
    with_views(
        "fx_prefs fx_token_embeddings",
        f"""SELECT 'bleu' AS metric, round(bleu, 6) AS value FROM ({bleu_sql(EVALUATED)})
            UNION ALL SELECT 'rouge1', round(avg(rouge1), 6) FROM ({rouge_n_sql(EVALUATED)})
            UNION ALL SELECT 'rouge2', round(avg(rouge2), 6) FROM ({rouge_n_sql(EVALUATED)})
            UNION ALL SELECT 'bertscore', round(avg(f1), 6) FROM ({BERT_SQL})""",
    ),
)
def f09(spark, folder):
    _, _, metrics = evaluated(spark, folder)
    names = ["bleu", "rouge1", "rouge2", "bertscore"]
    return long_scores(metrics, names).withColumn("value", F.round("value", 6))


@query(
    "f09_evaluation_subsequence_scores",
    with_views(
        "fx_prefs",
        f"""SELECT 'rougeL' AS metric, round(avg(rougeL), 6) AS value FROM ({rouge_l_sql(EVALUATED)})
            UNION ALL SELECT 'rougeLsum', round(avg(rougeLsum), 6) FROM ({rouge_lsum_sql(EVALUATED)})""",
    ),
)
def f09_subsequences(spark, folder):
    _, _, metrics = evaluated(spark, folder)
    return long_scores(metrics, ["rougeL", "rougeLsum"]).withColumn("value", F.round("value", 6))


@query(
    "a06_evaluation_document",
    with_views(
        "fx_prefs fx_token_embeddings",
        f"""SELECT (SELECT round(bleu, 6) FROM ({bleu_sql(EVALUATED)})) AS bleu,
                   (SELECT round(avg(rouge1), 6) FROM ({rouge_n_sql(EVALUATED)})) AS rouge1,
                   (SELECT round(avg(f1), 6) FROM ({BERT_SQL})) AS bertscore,
                   'conversations' AS dataset, count(*) AS size, count(*) AS evaluated, 'stub' AS model
            FROM fx_prefs""",
    ),
)
def a06(spark, folder):
    rows, scored, metrics = evaluated(spark, folder)
    path = write_evaluation(
        metrics, scored, new_path(spark, "evaluation"), DATASET, MODEL, dataset_size=rows.count()
    )
    document = spark.read.json(f"{path}/document")
    return document.select(
        F.round("metrics.bleu.bleu", 6).alias("bleu"),
        F.round("metrics.rouge.rouge1", 6).alias("rouge1"),
        F.round("metrics.bertscore.average_f1", 6).alias("bertscore"),
        F.col("dataset_info.name").alias("dataset"),
        F.col("dataset_info.size").alias("size"),
        F.col("dataset_info.evaluated").alias("evaluated"),
        F.col("model_info.id").alias("model"),
    )


def evaluated_folder(spark, folder):
    """The short table, and where one call has stored the rest."""
    path = new_path(spark, "evaluation")
    rows = preference_rows(spark, folder)
    vectors = token_embeddings(spark, folder)
    return evaluation.evaluate(rows, load_stub, path, DATASET, MODEL, embed=lambda pairs: vectors), path


@query(
    "f09_evaluate",
    with_views(
        "fx_prefs fx_token_embeddings",
        f"""SELECT 'bleu' AS metric, round(bleu, 6) AS value FROM ({bleu_sql(EVALUATED)})
            UNION ALL SELECT 'rougeL', round(avg(rougeL), 6) FROM ({rouge_l_sql(EVALUATED)})
            UNION ALL SELECT 'bertscore', round(avg(f1), 6) FROM ({BERT_SQL}) JOIN fx_prefs ON idx = pair_id""",
    ),
)
def f09_evaluate(spark, folder):
    table, _ = evaluated_folder(spark, folder)
    return table.withColumn("value", F.round("value", 6))


@query(
    "f09_pair_scores",
    with_views(
        "fx_prefs fx_token_embeddings",
        f"""SELECT pair_id, round(rouge1, 6) AS rouge1, round(rouge2, 6) AS rouge2, round(rougeL, 6) AS rougeL,
                   round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
            FROM ({rouge_n_sql(EVALUATED)}) JOIN ({rouge_l_sql(EVALUATED)}) USING (pair_id) LEFT JOIN ({BERT_SQL}) USING (pair_id)""",
    ),
)
def f09_pairs(spark, folder):
    _, path = evaluated_folder(spark, folder)
    scores = ["rouge1", "rouge2", "rougeL", "precision", "recall", "f1"]
    return spark.read.parquet(f"{path}/scores").select("pair_id", *[F.round(c, 6).alias(c) for c in scores])
