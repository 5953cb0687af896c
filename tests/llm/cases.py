"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Other names that operators use inside; they must come back untouched.
CLASHING = ("size", "seats", "base", "_key", "_n", "_id", "n_words", "count", "target", "_row", "part", "kept", "_own", "_k", "_copies")


def documents(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def with_clashes(docs):
    return docs.select("*", *[F.lit(f"kept {c}").alias(c) for c in CLASHING])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
