"""Text expressions: stripping, chat templates, token splitting.

All of these are native column expressions, so they stay in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.strip()/str.split() call whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       "
    "         　"
)
# The same set as a regular-expression class body.
WHITESPACE_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"

# A token is a run of letters, digits and underscores, or one other visible character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\t-\r \p{L}\p{N}_]"

# Chat template headings by role.  Other roles render as nothing.
ROLE_HEADINGS = {"user": "### User:\n", "assistant": "### Assistant:\n"}


def strip(text: Column) -> Column:
    """``str.strip()``: drop leading and trailing whitespace of any script."""
    return F.trim(text, F.lit(WHITESPACE))


def render_message(role: Column, content: Column) -> Column:
    """One message in the chat template; NULL for roles that do not render."""
    user, assistant = ROLE_HEADINGS["user"], ROLE_HEADINGS["assistant"]
    return F.when(role == "user", F.concat(F.lit(user), content, F.lit("\n"))).when(
        role == "assistant", F.concat(F.lit(assistant), content, F.lit("\n"))
    )


def render_chat(messages: Column) -> Column:
    """A whole chat (array of role/content) in the chat template."""
    parts = F.transform(messages, lambda m: render_message(m["role"], m["content"]))
    return F.array_join(parts, "")


def render_best_response(prompt: Column, response: Column) -> Column:
    return F.concat(F.lit("USER: "), prompt, F.lit("\nASSISTANT: "), response)


def tokens(text: Column) -> Column:
    """Array of tokens."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(text: Column, tokenizer=None, n_special: int = 0) -> Column:
    """Untruncated token count.

    ``tokenizer`` may be a picklable callable ``list[str] -> list[int]`` giving
    lengths; it then runs as an Arrow-batched UDF.  ``n_special`` is the number
    of special tokens an encoder adds to every text.
    """
    if tokenizer is None:
        return (F.size(tokens(text)) + n_special).cast("long")

    def lengths(texts):
        import pandas as pd

        return pd.Series(tokenizer(list(texts)), dtype="int64")

    # non-deterministic marking keeps the optimiser from evaluating it twice
    counted = F.pandas_udf(lengths, "long", F.PandasUDFType.SCALAR).asNondeterministic()
    return counted(text) + F.lit(n_special).cast("long")


# The four mteval-13a substitutions, applied in this order.
BLEU_STEPS = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# One pass with the same words, for text without several points before a digit: symbols,
# points and commas not between two digits, and hyphens after a digit stand alone.
_BLEU_ALONE = r"[\{-\~\[-\`!-\&\(-\+\:-\@\/]|(?<![0-9])[\.,]|[\.,](?![0-9])|(?<=[0-9])-"
_POINTS_BEFORE_DIGIT = r"[\.,]{2}[0-9]"


def bleu_tokens(text: Column) -> Column:
    """The public mteval-13a word splitting used for BLEU.

    Consecutive points are consumed in pairs by the substitutions, which one pass
    cannot mirror when a digit follows; such rare texts go through all four.
    """
    t = F.replace(text, F.lit("<skipped>"), F.lit(""))
    t = F.replace(t, F.lit("-\n"), F.lit(""))
    t = F.replace(t, F.lit("\n"), F.lit(" "))
    for entity, char in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    stepwise = t
    for pattern, by in BLEU_STEPS:
        stepwise = F.regexp_replace(stepwise, pattern, by)
    spaced = F.when(t.rlike(_POINTS_BEFORE_DIGIT), stepwise).otherwise(
        F.regexp_replace(t, _BLEU_ALONE, " $0 ")
    )
    return non_empty(F.split(F.translate(spaced, WHITESPACE, " " * len(WHITESPACE)), " "))


def rouge_clean(text: Column) -> Column:
    """Lower-case, everything but a-z and 0-9 turned into single spaces."""
    return F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " ")


def rouge_clean_lines(text: Column) -> Column:
    """The same line by line, newlines kept.

    A class that also excepts the newline makes Java's matcher many times slower.
    """
    return F.array_join(F.transform(F.split(text, "\n"), rouge_clean), "\n")


def rouge_tokens(text: Column) -> Column:
    return non_empty(F.split(rouge_clean(text), " "))


def non_empty(parts: Column) -> Column:
    return F.array_remove(parts, "")
