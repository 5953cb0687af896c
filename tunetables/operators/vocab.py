"""Vocabulary tables, encoding, padding and decoding.

A vocabulary is a table ``(token, id)`` of any size and is never broadcast.  Documents are
dealt by their key to chunks of bounded size; the distinct items of a chunk meet the
vocabulary in a join, and the chunk is then translated whole, array by array.  No token of
a document becomes a row that is shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetables.functions import text as tx
from tunetables.operators.ordering import ranked
from tunetables.session import written

UNKNOWN = "<unk>"
# Bytes of text, or of ids, that are translated in one group.
CHUNK_BYTES = 32 << 20


def token_frequencies(texts: DataFrame, column: str = "text") -> DataFrame:
    """``(token, freq)`` over whole texts, summed map-side before the shuffle."""
    return (
        texts.select(F.explode(tx.tokens(F.col(column))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"))
    )


def build_vocabulary(
    texts: DataFrame, column: str = "text", size: int | None = None
) -> DataFrame:
    """``(token, freq, id)``: most frequent first, ties by token; id 0 is unknown.

    ``size`` keeps the most frequent tokens only (an encoder's vocabulary size);
    others then encode as unknown.  Without it every token gets an id.
    """
    order = (F.col("freq").desc(), F.col("token").asc())
    words = ranked(token_frequencies(texts, column), *order, rank="_rank").select(
        "token", "freq", (F.col("_rank") + 1).alias("id")
    )
    return words if size is None else words.where(F.col("id") <= size)


def _merged(lists: list[list], keys: list) -> list[list]:
    """Rows with one key share the items of all of them, by place and value; a NULL key has none."""
    rows: dict = {}
    for i, key in enumerate(keys):
        rows.setdefault(key, []).append(i)
    out = [[] if key is None else items for key, items in zip(keys, lists, strict=True)]
    for key, same in rows.items():
        if key is not None and len(same) > 1:
            together = [item for _, item in sorted(pair for i in same for pair in enumerate(lists[i]))]
            for i in same:
                out[i] = together
    return out


def _translator(key: str, columns: Sequence[str], default) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def translate(docs: pa.Table, entries: pa.Table) -> pa.Table:
        # Arrow's hash of the chunk's items; what the vocabulary lacks has a NULL value here
        items, values = (entries[c].combine_chunks() for c in ("_item", "_value"))
        values = pc.fill_null(values, default)
        keys = docs[key].combine_chunks()
        known = pc.drop_null(keys)
        unlike = len(known) == len(keys) and len(pc.unique(keys)) == len(keys)
        for column in columns:
            lists = docs[column].combine_chunks()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_pylist()
            offsets = [0]
            for size in sizes:
                offsets.append(offsets[-1] + size)
            # an item that the entries lack is NULL itself
            found = pc.fill_null(values.take(pc.index_in(lists.flatten(), value_set=items, skip_nulls=True)), default)
            out = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)
            if not unlike:
                out = pa.array(_merged(out.to_pylist(), keys.to_pylist()), out.type)
            docs = docs.set_column(docs.column_names.index(column), column, out)
        return docs.drop_columns("_chunk")

    return translate


def _translated(
    df: DataFrame,
    columns: dict[str, Column],
    size: Column,
    table: DataFrame,
    default: int | str,
    key: str,
) -> DataFrame:
    """``df`` with arrays ``columns`` whose items are replaced as ``table`` says (item first, value second).

    ``size`` is a row's bytes.  ``df`` is read three times: for its size, for the items of
    each chunk and for the rows; pass a table that is stored or cheap to derive.
    """
    spark = df.sparkSession
    item, value = table.columns
    total = df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    chunks = total // CHUNK_BYTES + 1
    # chunks are groups of their own, so tasks may take several
    tasks = max(chunks, min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (1 << 20) + 1))
    # rows without a key stay apart from each other
    by = F.pmod(F.xxhash64(key, F.when(F.col(key).isNull(), size)), F.lit(tasks)).cast("int")
    placed = df.withColumn("_chunk", by).repartition(tasks, "_chunk").sortWithinPartitions("_chunk")
    kept = [c for c in df.columns if c not in columns]
    listed = placed.select(*kept, *[c.alias(name) for name, c in columns.items()], "_chunk")
    each = placed.select("_chunk", F.explode(F.array(*columns.values())).alias("_items"))
    distinct = each.select("_chunk", F.explode("_items").alias("_item")).where("_item IS NOT NULL").distinct()
    values = table.select(F.col(item).alias("_item"), F.col(value).alias("_value"))
    entries = distinct.join(values, "_item").select(F.col("_chunk").alias("_of"), "_item", "_value")
    kinds = {"int": "array<int>", "str": "array<string>"}
    fields = [f"`{name}` {df.schema[name].dataType.simpleString()}" for name in kept]
    fields += [f"`{name}` {kinds[type(default).__name__]}" for name in columns]
    translate = _translator(key, list(columns), default)
    return listed.groupBy("_chunk").cogroup(entries.groupBy("_of")).applyInArrow(translate, ", ".join(fields))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    columns: Sequence[str],
    key: str = "idx",
    max_length: int | None = None,
    unk_id: int = 0,
) -> DataFrame:
    """Add ``<column>_ids`` arrays for each text column.

    With ``max_length`` texts are cut before their tokens are looked up.  ``df`` is read
    three times; pass a table that is stored or cheap to derive.
    """
    toks = {}
    for column in columns:
        made = tx.tokens(F.col(column))
        toks[f"{column}_ids"] = made if max_length is None else F.slice(made, 1, max_length)
    size = sum((F.coalesce(F.octet_length(column), F.lit(0)) for column in columns), F.lit(0))
    ids = vocab.select("token", F.col("id").cast("int").alias("id"))
    return _translated(df, toks, size, ids, unk_id, key)


def truncated(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def padded(ids: Column, length: Column, pad_id: Column, side: str = "left") -> Column:
    """Pad an id array to ``length`` on the given side."""
    fill = F.array_repeat(pad_id.cast("int"), (length - F.size(ids)).cast("int"))
    if side == "left":
        return F.concat(fill, ids)
    if side == "right":
        return F.concat(ids, fill)
    raise ValueError(f"pad side must be left or right, not {side!r}")


def attention_mask(ids: Column, length: Column, side: str = "left") -> Column:
    """1 for each real token, 0 for padding."""
    ones = F.transform(ids, lambda _: F.lit(1))
    return padded(ones, length, F.lit(0), side)


def fixed_length(
    df: DataFrame, columns: Sequence[str], max_length: int, pad_id: Column, side: str = "left"
) -> DataFrame:
    """``<name>_input_ids`` and ``<name>_attention_mask`` of exactly ``max_length``.

    ``columns`` maps from id columns called ``<name>_ids``; ``pad_id`` is a literal
    or a column of ``df``.
    """
    length = F.lit(max_length)
    out = df
    for name in columns:
        ids = truncated(F.col(f"{name}_ids"), max_length)
        out = out.withColumn(f"{name}_input_ids", padded(ids, length, pad_id, side))
        out = out.withColumn(f"{name}_attention_mask", attention_mask(ids, length, side))
    return out.drop(*[f"{name}_ids" for name in columns])


def pad_token_id(vocab: DataFrame, pad_token: str | None, eos_token: str) -> DataFrame:
    """One-row ``(pad_id)``: the padding token's id, else the end token's."""
    found = vocab.where(F.col("token").isin([t for t in (pad_token, eos_token) if t is not None]))
    of = lambda token: F.max(F.when(F.col("token") == F.lit(token), F.col("id")))
    return found.agg(F.coalesce(of(pad_token), of(eos_token)).alias("pad_id"))


def pad_batches(
    df: DataFrame,
    batch_size: int,
    pad_id: Column,
    ids: str = "ids",
    idx: str = "idx",
    side: str = "left",
) -> DataFrame:
    """Pad each batch of consecutive rows to its own longest row."""
    # at most batch_size rows per window
    batch = F.floor(F.col(idx) / batch_size).cast("long")
    longest = F.max(F.size(ids)).over(Window.partitionBy("batch"))
    return (
        df.withColumn("batch", batch)
        .withColumn("longest", longest.cast("long"))
        .withColumn(ids, padded(F.col(ids), F.col("longest"), pad_id, side))
    )


def decode(
    df: DataFrame,
    vocab: DataFrame,
    ids: str = "ids",
    prompt_len: Column | None = None,
    special_tokens: Sequence[str] = (),
    key: str = "idx",
    separator: str = " ",
) -> DataFrame:
    """``(key, text)``: drop the prompt's ids and special tokens, join token strings."""
    generated = F.col(ids)
    if prompt_len is not None:
        generated = F.slice(generated, prompt_len + 1, F.size(ids))
    rows = df.select(key, generated.alias("_words"))
    size = 8 * F.greatest(F.size("_words"), F.lit(0))
    id_type = df.schema[ids].dataType.elementType
    tokens = vocab.select(F.col("id").cast(id_type).alias("id"), "token")
    words = _translated(rows, {"_words": F.col("_words")}, size, tokens, UNKNOWN, key)
    special = list(special_tokens)
    kept = F.filter("_words", lambda token: ~token.isin(special)) if special else F.col("_words")
    return words.select(key, F.array_join(kept, separator).alias("text"))


def stored_vocabulary(vocab: DataFrame) -> DataFrame:
    """Write a vocabulary once so that later jobs do not rebuild it."""
    return written(vocab, "vocabulary")
