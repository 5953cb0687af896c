"""Mixing sources to target weights by Sainte-Lague quotas of equal-token blocks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetables.llm.common import BLANK, WORD, n_words, packed
from tunetables.session import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Words of a block, and documents of a shard about.
BLOCK = 32
SHARD = 4096


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a source: ``source, _sid, source_size, _rows, target``.

    Sources in the order of their code points, null last, take the weights in turn and share
    ``share`` times all sizes; a target stops at ``most`` times its source's size, and what is
    over goes to the others by weight.  That is a common level L with target = min(most * size,
    L * weight); in the order of most * size / weight the sources that stop come first, so L
    needs running sums only.  One task sees a row for each source.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    found = found.withColumn("_sid", place.cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_sid") % len(weights) + 1).cast("int"))
    found = found.withColumns({"_weight": weight, "_stop": F.lit(float(most)) * F.col("source_size")})
    order = Window.orderBy(F.col("_stop") / F.col("_weight"), "_sid")
    before, on = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_stop").over(before), F.lit(0.0))) / F.sum("_weight").over(on)
    found = found.withColumns({"_level": level, "_at": F.row_number().over(order)})
    free = F.when(F.col("_level") <= F.col("_stop") / F.col("_weight"), F.struct("_at", "_level"))
    found = found.withColumn("_free", F.min(free).over(everything)["_level"])
    target = F.least("_stop", F.coalesce(F.col("_free") * F.col("_weight"), F.col("_stop")))
    return found.select("source", "_sid", "source_size", "_rows", target.alias("target"))


def apportioned(votes: DataFrame, seats: Column, by: Sequence[str], key: str) -> DataFrame:
    """``votes`` with ``seats``: a whole number for each row, by the highest quotients votes / (2k+1).

    In every group of ``by`` the seats of its rows add up to ``seats`` (the same in all rows of
    the group); equal quotients go to the smaller ``key``.  Columns: ``votes`` (double).  A common
    quotient is bracketed from the sums, so only some four quotients for each row are ranked,
    however many seats there are.
    """
    group = Window.partitionBy(*by)
    rows = votes.withColumns({"_seats": seats.cast("long"), "_n": F.count("*").over(group), "_all": F.sum("votes").over(group)})
    some = (F.col("_all") > 0) & (F.col("_seats") > 0)
    low, high = 2 * F.col("_seats") - F.col("_n"), 2 * F.col("_seats") + F.col("_n")
    sure = F.greatest(F.lit(0), F.floor((F.col("votes") * low / F.col("_all") - 1) / 2)).cast("long")
    most = F.ceil((F.col("votes") * high / F.col("_all") + 1) / 2).cast("long")
    rows = rows.withColumns({"_sure": F.when(some, sure).otherwise(0), "_most": F.when(some, F.greatest(sure, most)).otherwise(0)})
    rows = rows.withColumn("_left", F.when(some, F.col("_seats") - F.sum("_sure").over(group)).otherwise(0))
    each = rows.withColumn("_k", F.explode(F.sequence("_sure", "_most")))
    rank = F.row_number().over(group.orderBy(F.desc(F.col("votes") / (2 * F.col("_k") + 1)), key, "_k"))
    won = F.sum(F.when(F.col("_rank") <= F.col("_left"), 1).otherwise(0))
    keep = [c for c in votes.columns if c not in (*by, key)]
    return (
        each.withColumn("_rank", rank)
        .groupBy(*by, key)
        .agg(*[F.first(c).alias(c) for c in keep], (F.first("_sure") + won).cast("long").alias("seats"))
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 17,
) -> DataFrame:
    """Words that the mix takes of each document: ``doc_id, size, source_size, target, taken``.

    All targets together are cut into blocks of ``block`` words.  Sources get blocks by highest
    quotients, and so do the shards of a source (documents dealt by a seeded hash, about ``shard``
    in each, so a source with a third of all rows is as many tasks as it needs).  A shard lays its
    documents in seeded order, goes round its blocks from a seeded one on, and takes as many as
    its quota says; ``taken`` is what falls into a document.  The last block of a shard is short,
    so that a source misses its target by some words a shard.  Blocks are intervals and never rows.

    A null or empty text has size 0 and nothing is taken; null sources are one source, the last.
    Repeated rows are laid out each for itself.  An empty table gives no rows.
    """
    laid, inside, last = _laid(docs, weights, share, most, block, shard, seed)
    some = inside(F.col("_first"), F.least(last, F.col("_blocks"))) + inside(F.lit(0), last - F.col("_blocks"))
    taken = F.least(F.lit(most) * F.col("size"), F.col("_rounds") * F.col("size") + some)
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _laid(
    docs: DataFrame, weights: Sequence[float], share: float, most: int, block: int, shard: int, seed: int, keys: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[Column, Column], Column], Column]:
    """Documents on the lines of their shards, the words of a document in a range of blocks, and the last block.

    ``keys`` are columns that come along; they order documents of one id and size.
    """
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), *keys)
    sized = written(sized, "mix-sizes")
    targets = written(source_targets(sized, weights, share, most), "mix-targets")
    votes = targets.withColumn("votes", F.col("target"))
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block)
    quotas = apportioned(votes.withColumn("_one", F.lit(1)), blocks, ["_one"], "_sid").drop("_one", "votes")
    quotas = written(quotas.withColumn("_shards", F.ceil(F.col("_rows") / shard).cast("long")), "mix-quotas")

    # a source is found by its text; quotas have one row for each source
    named = sized.withColumn("_null", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    keyed = quotas.withColumn("_null", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    own = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.col("_shards"))
    laid = named.join(keyed.select("source", "_null", "_sid", "_shards", "source_size", "target"), ["source", "_null"]).withColumn("_shard", own)

    cells = laid.groupBy("_sid", "_shard").agg(F.sum("size").alias("_words"))
    cells = cells.join(quotas.select("_sid", F.col("seats").alias("_quota")), "_sid")
    cells = cells.withColumn("votes", F.col("_words").cast("double"))
    shared = apportioned(cells, F.col("_quota"), ["_sid"], "_shard").select("_sid", "_shard", "_words", "seats")

    line = Window.partitionBy("_sid", "_shard").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id", "size", *keys)
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    laid = laid.withColumn("_end", end).join(shared, ["_sid", "_shard"])
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("_words") / block)).cast("long")
    laid = laid.withColumns({"_blocks": n_blocks, "_start": F.col("_end") - F.col("size")})
    laid = laid.withColumns(
        {
            "_rounds": F.floor(F.col("seats") / F.col("_blocks")),
            "_rest": F.col("seats") % F.col("_blocks"),
            "_first": F.pmod(F.xxhash64(F.lit(seed), "_sid", "_shard"), F.col("_blocks")),
        }
    )

    def inside(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("_end"), b * block) - F.greatest(F.col("_start"), a * block))

    return laid, inside, F.col("_first") + F.col("_rest")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it: ``taken / size``, rounded half up.

    Documents are joined to their shares by ``doc_id`` (rows of one id and size share the mean).
    """
    takes = mix(docs, **options).groupBy("doc_id", "size").agg(F.avg("taken").alias("_taken"))
    copies = F.when(F.col("size") > 0, F.floor(F.col("_taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    takes = takes.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), copies.alias("_copies")).where("_copies > 0")
    own = packed(docs, _own=F.col("doc_id"), _n=n_words(F.col("text")))
    joined = own.join(takes, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_n") == F.col("_size")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")


def mixed_texts(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 17,
) -> DataFrame:
    """The words that the mix takes, in rows of ``docs``: whole rows, and a part of a partly taken text.

    A part is a run of words with the blanks between them, a row of its own beside the whole ones;
    ``n_chars``, where there is such a column of numbers, is its length.  So a source has as many words
    as ``mix`` takes of it.  A row is found by a hash of its columns; equal rows are interchangeable.
    """
    hashed = [docs[f"`{f.name}`"] for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    key = F.xxhash64(*hashed)
    given = docs.select("doc_id", "source", "text", key.alias("_key"))
    laid, inside, last = _laid(given, weights, share, most, block, shard, seed, ["_key"])
    none = F.array().cast("array<struct<a:bigint,b:bigint>>")

    def cut(a: Column, b: Column) -> Column:
        first = F.greatest(F.lit(0), a * block - F.col("_start"))
        return F.struct(first.cast("long").alias("a"), (first + inside(a, b)).cast("long").alias("b"))

    two = F.array(cut(F.lit(0), last - F.col("_blocks")), cut(F.col("_first"), F.least(last, F.col("_blocks"))))
    parts = F.when(F.col("_rounds") < most, F.filter(two, lambda x: x["a"] < x["b"])).otherwise(none)
    laid = laid.select("doc_id", "_key", "size", F.least("_rounds", F.lit(most)).alias("_rounds"), parts.alias("_parts"))
    full = F.exists("_parts", lambda x: x["b"] - x["a"] == F.col("size"))
    laid = laid.withColumns({"_whole": F.when(F.col("size") > 0, F.col("_rounds") + full.cast("long")).otherwise(0), "_parts": F.when(full, none).otherwise(F.col("_parts"))})
    # equal rows are in one shard, which cuts few documents
    takes = laid.where("_whole > 0 OR size(_parts) > 0").groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_own"), "_key")
    takes = takes.agg(F.sum("_whole").cast("int").alias("_whole"), F.flatten(F.collect_list(F.when(F.size("_parts") > 0, F.col("_parts")))).alias("_parts"))

    own = packed(docs, _own=F.coalesce(F.col("doc_id").cast("string"), F.lit("")), _key=key)
    joined = own.join(takes, ["_own", "_key"]).dropDuplicates(["_own", "_key"])
    # a whole row is a part from -1 on
    whole = F.array_repeat(F.struct(F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b")), F.col("_whole"))
    rows = joined.select("_row", F.explode(F.concat(whole, "_parts")).alias("_p"))
    words = F.slice(F.regexp_extract_all("_row.text", F.lit(f"{WORD}(?:{BLANK})?"), F.lit(0)), F.col("_p.a").cast("int") + 1, (F.col("_p.b") - F.col("_p.a")).cast("int"))
    part = F.regexp_replace(F.array_join(words, ""), f"{BLANK}$", "")
    rows = rows.withColumn("_text", F.when(F.col("_p.a") >= 0, part))
    row = F.col("_row").withField("text", F.coalesce("_text", F.col("_row.text")))
    kind = dict(docs.dtypes).get("n_chars")
    if kind in ("int", "bigint"):
        row = row.withField("n_chars", F.coalesce(F.length("_text").cast(kind), F.col("_row.n_chars")))
    return rows.select(row.alias("_row")).select("_row.*")
