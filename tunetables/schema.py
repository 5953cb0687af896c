"""Schemas of the tables this library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)

# One preference example: a prompt with a preferred and a rejected chat.
PREFERENCE = T.StructType(
    [
        T.StructField("idx", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("chosen", T.ArrayType(MESSAGE)),
        T.StructField("rejected", T.ArrayType(MESSAGE)),
    ]
)

# One chat message per row.
TURN = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

# One generated answer with the text it is scored against.
SCORED_PAIR = T.StructType(
    [
        T.StructField("pair_id", T.LongType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("reference", T.StringType()),
    ]
)

# One line of a training log before parsing.
LOG_LINE = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("line", T.StringType()),
    ]
)
