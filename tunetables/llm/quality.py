"""Text statistics and learned decision lists over them, as Spark expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetables.llm.common import BLANK, BLANKS, packed
from tunetables.session import written

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
#: Fixed base limits: fewest words, and most percent of words in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED = 30
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_chars_all")

#: What rules look at, as ratios of the statistics.
FEATURES = {
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_ratio": "n_symbols / greatest(n_words, 1)",
    "dup_lines_ratio": "n_dup_lines / greatest(n_words, 1)",
    "repeat_ratio": "n_repeat_words / greatest(n_words, 1)",
    "upper_ratio": "n_upper / greatest(word_chars, 1)",
    "words": "cast(n_words as double)",
}


def _array(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``STATISTICS`` as longs.

    ``n_repeat_words`` compares windows of eight words by a 64-bit hash: windows are sorted with
    their places, those with an equal neighbour are put in order of place, and each covers the
    words up to the next one, eight at most.  Work follows the length of the text (times its
    logarithm), whatever repeats.  Null and empty texts have 0 everywhere.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stripped = F.trim(body, F.lit(BLANKS))
    words = F.when(F.length(stripped) > 0, F.split(stripped, BLANK)).otherwise(_array("string"))
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0)
    rows = docs.withColumns({"_words": words, "_lines": lines})
    n = F.size("_words")
    rows = rows.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_upper": F.regexp_count(body, F.lit(r"\p{Lu}")).cast("long"),
            "n_chars_all": F.length(body).cast("long"),
        }
    )
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    places = F.sequence(F.lit(0), n - WINDOW)
    windows = F.transform(places, lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)]))
    rows = rows.withColumn("_windows", F.when(n >= WINDOW, windows).otherwise(_array("bigint")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    sorted_ = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(repeats, sorted_).otherwise(_array("struct<h:bigint,i:int>")))
    twice = F.filter("_sorted", lambda x, j: (x["h"] == F.get("_sorted", j - 1)["h"]) | (x["h"] == F.get("_sorted", j + 1)["h"]))
    rows = rows.withColumn("_twice", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.transform("_twice", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_twice", j + 1) - i, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", total).drop("_words", "_lines", "_hashes", "_windows", "_sorted", "_twice")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def __str__(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.limit!r}D"


@dataclass(frozen=True)
class Rule:
    """All conditions hold: the document is rejected.  ``bad`` and ``good``: labelled rows it took."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression of a decision list: 0 for kept, else the number of the rule."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        out = F.when(F.expr(str(rules[k - 1])), k).otherwise(out)
    return out


def _binned(rows: DataFrame, limits: dict[str, list[float]]) -> DataFrame:
    """Rows with, for each feature, the number of its limits that lie below the value; counted by these."""
    bins = [sum((F.expr(f"int(({FEATURES[f]}) > {x!r}D)") for x in xs), F.lit(0)).alias(f) for f, xs in limits.items()]
    half = (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0).alias("pruning")
    return rows.select(*bins, half, (F.col("quality") == 0).alias("bad")).groupBy(*limits, "pruning", "bad").count()


def learn_rules(
    labelled: DataFrame, most_rules: int = 6, most_conditions: int = 3, bins: int = 24, precision: float = 0.95, support: int = 5
) -> list[Rule]:
    """A decision list for bad documents by sequential covering.

    ``labelled`` has the statistics, ``doc_id`` and ``quality`` (0: bad; rows with null or other
    labels teach nothing bad).  Limits of a feature are up to ``bins`` quantiles of the bad and of
    the good rows.  A rule grows by the condition with the best gain in information on two thirds
    of the rows not yet covered, and is pruned from its end by its precision on the other third; it
    is taken if it has ``support`` bad rows and ``precision`` on both together.  Each step is one
    aggregate that gives a count for every feature, limit and class, so the driver sees some
    hundred numbers.  The list is empty when nothing separates, and when there are no labels.
    """
    shares = [(k + 0.5) / bins for k in range(bins)]
    limits: dict[str, list[float]] = {}
    quant = [F.percentile_approx(F.when(c, F.expr(e)), shares, 2000).alias(f"{f}_{k}") for f, e in FEATURES.items() for k, c in enumerate((F.col("quality") == 0, F.col("quality") != 0))]
    row = labelled.agg(*quant).first()
    for f in FEATURES:
        limits[f] = sorted({float(x) for k in (0, 1) for x in row[f"{f}_{k}"] or []})
    counts = written(_binned(labelled, limits).coalesce(1), "rule-counts")

    def covers(conditions: list[tuple[str, bool, int]]) -> Column:
        out = F.lit(True)
        for f, above, k in conditions:
            out = out & ((F.col(f) > k) if above else (F.col(f) <= k))
        return out

    def tally(rows: DataFrame) -> dict[tuple[str, int], list[int]]:
        """For each feature and bin: bad and good rows."""
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("k")) for f in limits])).alias("p")
        got = rows.select(pairs, "bad", "count").groupBy("p.f", "p.k", "bad").agg(F.sum("count").alias("n"))
        out: dict[tuple[str, int], list[int]] = {}
        for r in got.collect():  # features x bins x 2 rows at most
            out.setdefault((r["f"], r["k"]), [0, 0])[0 if r["bad"] else 1] += r["n"]
        return out

    def gain(bad: int, good: int, bad0: int, good0: int) -> float:
        from math import log2

        return bad * (log2(bad / (bad + good)) - log2(bad0 / (bad0 + good0))) if bad else 0.0

    rules, rest = [], counts.where("bad IS NOT NULL")
    while len(rules) < most_rules:
        grown: list[tuple[str, bool, int]] = []
        while len(grown) < most_conditions:
            by = tally(rest.where(~F.col("pruning")).where(covers(grown)))
            first = next(iter(limits))
            bad0, good0 = (sum(v[i] for (f, _), v in by.items() if f == first) for i in (0, 1))
            if bad0 < support or not good0:
                break
            options = []
            for f, xs in limits.items():
                bad = good = 0
                for k in range(len(xs) + 1):
                    b, g = by.get((f, k), (0, 0))
                    bad, good = bad + b, good + g
                    if k < len(xs):
                        options.append((gain(bad0 - bad, good0 - good, bad0, good0), f, True, k))
                        options.append((gain(bad, good, bad0, good0), f, False, k))
            best = max(options)
            if best[0] <= 1e-9:
                break
            grown.append(best[1:])
        if not grown:
            break
        held = [
            F.sum(F.when(covers(grown[:m]) & (F.col("bad") == b) & (F.col("pruning") | F.lit(whole)), F.col("count")).otherwise(0)).alias(f"c{m}_{int(b)}_{int(whole)}")
            for m in range(1, len(grown) + 1)
            for b in (True, False)
            for whole in (True, False)
        ]
        n = rest.agg(*held).first()
        value = [((n[f"c{m}_1_0"] + 1) / (n[f"c{m}_1_0"] + n[f"c{m}_0_0"] + 2), -m) for m in range(1, len(grown) + 1)]
        m = -max(value)[1]
        bad, good = n[f"c{m}_1_1"], n[f"c{m}_0_1"]
        if bad < support or bad < precision * (bad + good):
            break
        conditions = tuple(Condition(f, above, limits[f][k] if above or k < len(limits[f]) else float("inf")) for f, above, k in grown[:m])
        rules.append(Rule(conditions, bad, good))
        rest = rest.where(~covers(grown[:m]))
    return rules


def judged(docs: DataFrame, labels: DataFrame, label_rows: int = 200_000, **options) -> DataFrame:
    """``docs`` with the statistics, ``base_failed``, ``rule`` (0: none) and ``kept``.

    The list is learned from at most about ``label_rows`` labelled documents, chosen by a hash of
    their id (all of them where there are fewer); it is applied to every row.  A document is kept
    unless it fails a base limit or a rule rejects it.  Labels whose ids repeat with one quality
    count once; ids with both qualities teach nothing.  Null ids match no label.
    """
    one = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("_q"))
    one = one.where("quality = _q").drop("_q")
    total = one.count()
    if total > label_rows:
        one = one.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) < int(1_000_000 * label_rows / total))
    stats = written(statistics(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("_key"), *STATISTICS), "text-statistics")
    rules = learn_rules(stats.join(one, "doc_id"), **options)
    return stats.withColumns({"base_failed": base_failed(), "rule": verdict(rules)}).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def quality_verdicts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rule``."""
    rows = judged(docs, labels, **options)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, in their own columns."""
    rows = judged(docs, labels, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")).distinct()
    own = packed(docs, _own=F.col("doc_id"), _text=F.xxhash64("text"))
    return own.join(rows, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_k")), "left_semi").select("_row.*")
