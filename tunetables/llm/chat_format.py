"""Roles of transcript lines by a hidden Markov model, and turns in one canonical form."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.operators.ordering import ranked, running_total
from tunetables.session import written

ROLES = ("system", "user", "assistant")
#: States: the first line of a role's turn, then a further line of it; the last stands before all lines.
STATES = 2 * len(ROLES)
BEFORE = STATES
#: Speaker markers that open a line, by role.  Fixed lists of what transcripts write.
MARKERS = (
    r"(?i)^\s*(?:###\s*|\*\*|\[|<\|)?(?:system|instructions?|context)(?:\*\*|\]|\|>)?\s*[:>]\s?",
    r"(?i)^\s*(?:###\s*|\*\*|\[|<\|)?(?:user|human|question|customer|q|you)(?:\*\*|\]|\|>)?\s*[:>]\s?",
    r"(?i)^\s*(?:###\s*|\*\*|\[|<\|)?(?:assistant|ai|bot|answer|agent|a|model)(?:\*\*|\]|\|>)?\s*[:>]\s?",
)
#: Lines of a chunk, and chunks that are looked at together.
CHUNK = 1024
CODES = 4 * 4 * 2 * 2


def line_code(line: Column, number: Column) -> Column:
    """What the model sees of a line: marker, length, question mark, whether it is the first."""
    marker = F.when(line.rlike(MARKERS[0]), 1).when(line.rlike(MARKERS[1]), 2).when(line.rlike(MARKERS[2]), 3).otherwise(0)
    n = F.length(F.trim(line))
    length = F.when(n == 0, 0).when(n <= 60, 1).when(n <= 240, 2).otherwise(3)
    asks = line.rlike(r"\?\s*$").cast("int")
    return (((marker * 4 + length) * 2 + asks) * 2 + (number == 0).cast("int")).cast("int")


def transcript_lines(turns: DataFrame) -> DataFrame:
    """``conversations`` as transcripts: ``conv_id, line_no, line, state`` (the true one).

    A transcript writes its speakers in one of four ways, chosen by its id, and one turn in eight
    without a marker.  Every row is in the result: several rows of one turn, equal ones too, follow each other
    by role and text, rows without a turn come last in their conversation, and a row without an id is a
    conversation of its own, with a negative id made by hash.  Other roles than the three are the user's, null
    texts are empty lines, long texts are split at their line ends only, other columns are not read.
    """
    own = F.expr(f"xxhash64('no id', _row) | {-(1 << 63)}L")
    given = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    given = given.withColumn("conv_id", F.coalesce(F.col("conv_id").cast("long"), own)).drop("_row")
    rows = ranked(given, F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"), rank="_order")
    role = F.when(F.col("role") == "system", 0).when(F.col("role") == "assistant", 2).otherwise(1)
    names = [("System: ", "User: ", "Assistant: "), ("### Instruction: ", "### Human: ", "### AI: "), ("**System**: ", "**Question**: ", "**Answer**: "), ("Context> ", "Q> ", "A> ")]
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(names))).cast("int")
    marker = F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, n)) for n in names]), style + 1), F.col("_role") + 1)
    rows = rows.withColumn("_role", role.cast("int"))
    marked = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) != 0
    rows = rows.withColumn("_lines", F.split(F.concat(F.when(marked, marker).otherwise(""), F.col("text")), "\n"))
    rows = written(rows.select("conv_id", "_order", "_role", "_lines"), "chat-turns")
    rows = running_total(rows, ["conv_id"], "_order", F.size("_lines"), before="_first", total="_all")
    lines = rows.select("conv_id", "_first", "_role", F.posexplode("_lines").alias("_at", "line"))
    return lines.select("conv_id", (F.col("_first") + F.col("_at")).alias("line_no"), "line", (F.col("_role") * 2 + (F.col("_at") > 0).cast("int")).alias("state"))


@dataclass(frozen=True)
class SpeakerModel:
    """Log-probabilities: ``move[i, j]`` from state i (``BEFORE`` at the start) to j, ``shows[j, code]``."""

    move: np.ndarray
    shows: np.ndarray

    def step(self, code: int) -> np.ndarray:
        out = np.full((STATES + 1, STATES + 1), -np.inf)
        out[:, :STATES] = self.move + self.shows[:, code]
        return out

    def steps(self) -> list[np.ndarray]:
        return [self.step(code) for code in range(CODES)]


def learned(lines: DataFrame) -> SpeakerModel:
    """A model from lines with their true ``state``, counted over all of them with one added to each count.

    A further line can only follow a line of its role, and the first line opens a turn.
    """
    rows = lines.withColumn("_code", line_code(F.col("line"), F.col("line_no")))
    chunks = rows.groupBy("conv_id", F.floor(F.col("line_no") / CHUNK).alias("_chunk")).agg(F.array_sort(F.collect_list(F.struct("line_no", "state"))).alias("x"))
    steps = F.zip_with(F.slice("x", 1, F.size("x") - 1), F.slice("x", 2, F.size("x") - 1), lambda a, b: F.struct(a["state"].alias("i"), b["state"].alias("j")))
    starts = F.filter("x", lambda s: s["line_no"] == 0)
    every = F.concat(F.when(F.size("x") > 1, steps).otherwise(F.array().cast("array<struct<i:int,j:int>>")), F.transform(starts, lambda s: F.struct(F.lit(BEFORE).alias("i"), s["state"].alias("j"))))
    moves = chunks.select(F.explode(every).alias("s")).groupBy("s.i", "s.j").count().collect()
    seen = rows.groupBy("state", "_code").count().collect()
    move, shows = np.ones((STATES + 1, STATES)), np.ones((STATES, CODES))
    for r in moves:
        move[r["i"], r["j"]] += r["count"]
    for r in seen:
        shows[r["state"], r["_code"]] += r["count"]
    further = np.arange(STATES) % 2 == 1
    allowed = ~further[None, :] | (np.arange(STATES + 1)[:, None] // 2 == np.arange(STATES)[None, :] // 2)
    move = np.where(allowed, move, 0)
    with np.errstate(divide="ignore"):
        return SpeakerModel(np.log(move / move.sum(axis=1, keepdims=True)), np.log(shows / shows.sum(axis=1, keepdims=True)))


def _product(steps: list[np.ndarray]) -> np.ndarray:
    """Best scores from each state before the steps to each state after them."""
    out = steps[0]
    for s in steps[1:]:
        out = (out[:, :, None] + s[None, :, :]).max(axis=1)
    return out


def _path(steps: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """The best states after each step between two states (the best last one if ``exit_`` is -1)."""
    score, back = np.full(STATES + 1, -np.inf), []
    score[entry] = 0.0
    for s in steps:
        every = score[:, None] + s
        back.append(every.argmax(axis=0))
        score = every.max(axis=0)
    out = [int(score.argmax()) if exit_ < 0 else exit_]
    for b in reversed(back[1:]):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _combined(parts: pd.Series) -> pd.Series:
    return pd.Series([_product([np.array(m).reshape(STATES + 1, -1) for m in ms]).ravel().tolist() for ms in parts])


def _exits(parts: pd.Series, entry: pd.Series, exit_: pd.Series) -> pd.Series:
    rows = zip(parts, entry, exit_, strict=True)
    return pd.Series([_path([np.array(m).reshape(STATES + 1, -1) for m in ms], a, b) for ms, a, b in rows])


def _bounds(chunks: DataFrame) -> DataFrame:
    """``conv_id, chunk, entry, exit`` of the best path; ``chunks`` has ``m``, the product of its steps.

    Chunks of a long conversation are themselves put into chunks, level by level, so no task
    sees more than ``CHUNK`` of them: products go up, the states between chunks come down.
    """
    chunks = written(chunks, "chat-chunks")
    most = chunks.agg(F.max("chunk")).first()[0] or 0
    by = chunks.withColumn("_up", F.floor(F.col("chunk") / CHUNK))
    groups = by.groupBy("conv_id", "_up").agg(F.array_sort(F.collect_list(F.struct("chunk", "m"))).alias("x"))
    groups = groups.select("conv_id", "_up", "x.chunk", "x.m")
    if most < CHUNK:
        groups = groups.withColumns({"entry": F.lit(BEFORE), "exit": F.lit(-1)})
    else:
        groups = written(groups, "chat-level")
        above = _bounds(groups.select("conv_id", F.col("_up").alias("chunk"), F.pandas_udf(_combined, "array<double>")("m").alias("m")))
        groups = groups.join(above.withColumnRenamed("chunk", "_up"), ["conv_id", "_up"])
    groups = groups.withColumn("_out", F.pandas_udf(_exits, "array<int>")("m", "entry", "exit"))
    into = F.concat(F.array("entry"), F.slice("_out", 1, F.size("_out") - 1))
    each = F.explode(F.arrays_zip(F.col("chunk"), into.alias("entry"), F.col("_out").alias("exit"))).alias("z")
    return groups.select("conv_id", each).select("conv_id", F.col("z.chunk").alias("chunk"), F.col("z.entry").alias("entry"), F.col("z.exit").alias("exit"))


def decoded(lines: DataFrame, model: SpeakerModel) -> DataFrame:
    """``conv_id, line_no, line, state``: the most probable states of each transcript (Viterbi).

    ``lines`` has ``conv_id, line_no, line``, numbered from 0 without gaps.  Lines are dealt to
    chunks of 1,024, so a conversation with a third of all lines is many tasks.
    """
    steps = model.steps()

    @F.pandas_udf("array<double>")
    def product(codes: pd.Series) -> pd.Series:
        return pd.Series([_product([steps[c] for c in own]).ravel().tolist() for own in codes])

    @F.pandas_udf("array<int>")
    def path(codes: pd.Series, entry: pd.Series, exit_: pd.Series) -> pd.Series:
        return pd.Series([_path([steps[c] for c in own], a, b) for own, a, b in zip(codes, entry, exit_, strict=True)])

    rows = lines.select("conv_id", "line_no", F.coalesce("line", F.lit("")).alias("line")).withColumn("_code", line_code(F.col("line"), F.col("line_no")))
    chunks = rows.groupBy("conv_id", F.floor(F.col("line_no") / CHUNK).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("line_no", "_code", "line"))).alias("x"))
    chunks = written(chunks.select("conv_id", "chunk", F.col("x.line_no").alias("numbers"), F.col("x._code").alias("codes"), F.col("x.line").alias("texts")), "chat-lines")
    bounds = _bounds(chunks.select("conv_id", "chunk", product("codes").alias("m")))
    whole = chunks.join(bounds, ["conv_id", "chunk"]).withColumn("states", path("codes", "entry", "exit"))
    one = F.explode(F.arrays_zip("numbers", "texts", "states")).alias("z")
    return whole.select("conv_id", one).select("conv_id", F.col("z.numbers").alias("line_no"), F.col("z.texts").alias("line"), F.col("z.states").alias("state"))


def turns_of(lines: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, rendered`` from decoded lines.

    A turn is an opening line and what follows it; its marker is taken off, and blank lines at its
    end.  ``rendered`` is the canonical form ``<|role|>\\ntext\\n<|end|>``.
    """
    state = F.col("state")
    numbered = running_total(written(lines, "chat-decoded"), ["conv_id"], "line_no", (state % 2 == 0).cast("long"), before="_before", total="_all")
    numbered = numbered.withColumn("turn", F.col("_before") - F.when(state % 2 == 0, 0).otherwise(1))
    marker = "(?i)" + "|".join(f"(?:{m.removeprefix('(?i)')})" for m in MARKERS)
    line = F.when(state % 2 == 0, F.regexp_replace("line", marker, "")).otherwise(F.col("line"))
    grouped = numbered.select("conv_id", "turn", F.floor(state / 2).cast("int").alias("_role"), "line_no", line.alias("line"))
    grouped = grouped.groupBy("conv_id", "turn").agg(F.first("_role").alias("_role"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("_role") + 1)
    text = F.rtrim(F.array_join(F.col("x.line"), "\n"), F.lit(" \t\n\r"))
    return grouped.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")).withColumn(
        "rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>"))
    )


def formatted(lines: DataFrame, model: SpeakerModel) -> DataFrame:
    """Turns of transcripts of unknown speakers; an empty table gives no rows."""
    return turns_of(decoded(lines, model))
