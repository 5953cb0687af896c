"""Queries over vocabularies, encoding, padding, packing and decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog.fixtures import MAX_LENGTH, documents, preference_rows, turns, with_views
from catalog.registry import query
from tunetables.functions import text as tx
from tunetables.operators import packing, pairs, vocab
from tunetables.plans import training_sets
from tunetables.session import written

FIXED_LENGTH = 128
BLOCK_LENGTH = 512
PAD_TOKEN, EOS_TOKEN = "<pad>", "."
SPECIAL_TOKENS = [".", ","]


def joined(ids: Column) -> Column:
    """Id arrays as text, one spelling for both engines."""
    return F.array_join(ids.cast("array<string>"), " ")


def document_vocabulary(spark, folder):
    return vocab.build_vocabulary(documents(spark, folder))


def encoded_documents(spark, folder, max_length=None):
    docs = documents(spark, folder)
    coded = vocab.encode(docs, document_vocabulary(spark, folder), ["text"], "doc_id", max_length)
    return coded.select("doc_id", F.col("text_ids").alias("ids"))


@query("c01_vocabulary", with_views("doc_vocab", "SELECT token, freq, CAST(id AS BIGINT) AS id FROM doc_vocab"))
def c01(spark, folder):
    return document_vocabulary(spark, folder)


ID_LISTS = """
  SELECT doc_id, count(id) AS n, coalesce(string_agg(id, ' ' ORDER BY place), '') AS ids
  FROM documents LEFT JOIN {ids} USING (doc_id) GROUP BY doc_id"""


@query("c02_encode", with_views("doc_ids", ID_LISTS.format(ids="doc_ids")))
def c02(spark, folder):
    coded = encoded_documents(spark, folder)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n"), joined(F.col("ids")).alias("ids"))


@query(
    "c03_truncate_pad",
    with_views(
        "doc_ids",
        f"""SELECT doc_id, repeat('0 ', CAST(128 - n AS INT)) || ids AS input_ids,
                   rtrim(repeat('0 ', CAST(128 - n AS INT)) || repeat('1 ', CAST(n AS INT))) AS attention_mask
            FROM ({ID_LISTS.format(ids="(SELECT * FROM doc_ids WHERE place <= 128)")})""",
    ),
)
def c03(spark, folder):
    coded = encoded_documents(spark, folder, FIXED_LENGTH).withColumnRenamed("ids", "text_ids")
    fixed = vocab.fixed_length(coded, ["text"], FIXED_LENGTH, F.lit(0))
    return fixed.select(
        "doc_id",
        joined(F.col("text_input_ids")).alias("input_ids"),
        joined(F.col("text_attention_mask")).alias("attention_mask"),
    )


def side_ids_sql(side: str) -> str:
    return rf"""
      SELECT idx, count(token) AS n,
             coalesce(string_agg(CASE WHEN token IS NOT NULL THEN coalesce(v.id, 0) END, ' ' ORDER BY place), '') AS ids
      FROM fx_prefs LEFT JOIN (
        SELECT idx, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM (
          SELECT idx, list_slice(regexp_extract_all(prompt || {side}, '[\p{{L}}\p{{N}}_]+|[^\t-\r \p{{L}}\p{{N}}_]'), 1, 256) AS t
          FROM fx_prefs)) USING (idx)
      LEFT JOIN chat_vocab v USING (token) GROUP BY idx"""


@query(
    "c04_dpo_table",
    with_views(
        "fx_prefs chat_vocab",
        f"""SELECT idx, prompt, chosen, rejected,
              repeat(pad || ' ', CAST(256 - c.n AS INT)) || c.ids AS chosen_input_ids,
              rtrim(repeat('0 ', CAST(256 - c.n AS INT)) || repeat('1 ', CAST(c.n AS INT))) AS chosen_attention_mask,
              repeat(pad || ' ', CAST(256 - r.n AS INT)) || r.ids AS rejected_input_ids,
              rtrim(repeat('0 ', CAST(256 - r.n AS INT)) || repeat('1 ', CAST(r.n AS INT))) AS rejected_attention_mask
            FROM fx_prefs JOIN ({side_ids_sql("chosen")}) c USING (idx) JOIN ({side_ids_sql("rejected")}) r USING (idx)
            CROSS JOIN (SELECT id AS pad FROM chat_vocab WHERE token = '{EOS_TOKEN}')""",
    ),
)
def c04(spark, folder):
    words = vocab.build_vocabulary(turns(spark, folder))
    table = training_sets.dpo_set(
        preference_rows(spark, folder), words, MAX_LENGTH, pad_token=PAD_TOKEN, eos_token=EOS_TOKEN
    )
    listed = [c for c in table.columns if c.endswith(("_ids", "_mask"))]
    return table.select(
        "idx", "prompt", "chosen", "rejected", *[joined(F.col(c)).alias(c) for c in listed]
    )


@query(
    "c05_pad_fallback",
    with_views(
        "doc_ids doc_vocab",
        f"""SELECT doc_id, (SELECT CAST(id AS BIGINT) FROM doc_vocab WHERE token = '.') AS pad_id,
                   greatest(512 - n, 0) AS n_pad
            FROM ({ID_LISTS.format(ids="doc_ids")})""",
    ),
)
def c05(spark, folder):
    pad = vocab.pad_token_id(document_vocabulary(spark, folder), PAD_TOKEN, EOS_TOKEN)
    used = tx.token_count(F.col("text"))
    return documents(spark, folder).select(
        "doc_id",
        pad.scalar().alias("pad_id"),
        F.greatest(F.lit(BLOCK_LENGTH) - used, F.lit(0)).alias("n_pad"),
    )


@query(
    "c06_packing",
    with_views(
        "doc_ids",
        """SELECT block, count(*) AS n_tokens, string_agg(id, ' ' ORDER BY place) AS ids FROM (
             SELECT id, row_number() OVER (ORDER BY doc_id, place) AS place,
                    CAST(floor((row_number() OVER (ORDER BY doc_id, place) - 1) / 512) AS BIGINT) AS block
             FROM doc_ids) GROUP BY block""",
    ),
)
def c06(spark, folder):
    blocks = packing.pack(encoded_documents(spark, folder), "ids", BLOCK_LENGTH, order="doc_id")
    return blocks.select("block", "n_tokens", joined(F.col("ids")).alias("ids"))


@query(
    "c07_decode",
    with_views(
        "pair_lengths chat_vocab",
        r"""SELECT idx, coalesce(string_agg(CASE WHEN token IS NULL OR v.id IS NOT NULL THEN token ELSE '<unk>' END,
                                       ' ' ORDER BY place), '') AS text
            FROM fx_prefs LEFT JOIN (
              SELECT idx, token, place FROM (
                SELECT idx, prompt_len, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM (
                  SELECT idx, prompt_len, regexp_extract_all(prompt || chosen, '[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]') AS t
                  FROM pair_lengths))
              WHERE place > prompt_len AND token NOT IN ('.', ',')) USING (idx)
            LEFT JOIN chat_vocab v USING (token) GROUP BY idx""",
    ),
)
def c07(spark, folder):
    words = vocab.build_vocabulary(turns(spark, folder))
    full = pairs.joined_texts(pairs.flat_pairs(preference_rows(spark, folder)))
    asked = full.select("idx", F.size(tx.tokens(F.col("prompt"))).alias("prompt_len"), "chosen_full")
    # stored, since encoding and decoding read their rows three times
    coded = vocab.encode(written(asked, "pairs"), words, ["chosen_full"]).select(
        "idx", "prompt_len", F.col("chosen_full_ids").alias("ids")
    )
    coded = written(coded, "encoded")
    return vocab.decode(coded, words, prompt_len=F.col("prompt_len"), special_tokens=SPECIAL_TOKENS)


@query(
    "c08_batch_padding",
    with_views(
        "doc_ids",
        f"""SELECT doc_id, CAST(floor(doc_id / 4) AS BIGINT) AS batch, longest,
                   rtrim(repeat('0 ', CAST(longest - n AS INT)) || ids) AS ids
            FROM (SELECT *, max(n) OVER (PARTITION BY CAST(floor(doc_id / 4) AS BIGINT)) AS longest
                  FROM ({ID_LISTS.format(ids="doc_ids")}))""",
    ),
)
def c08(spark, folder):
    padded = vocab.pad_batches(encoded_documents(spark, folder), 4, F.lit(0), idx="doc_id")
    return padded.select("doc_id", "batch", "longest", joined(F.col("ids")).alias("ids"))
