"""Benchmark decontamination: a BM25 index of test items, asked with every passage of the corpus."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetables.llm.common import packed
from tunetables.session import written

K1, B = 1.2, 0.75
#: An item is retrieved by a passage that reaches this share of the item's own score.
SHARE = 0.6
#: Share of an item's score that its commonest terms may hold without being looked up.
IDLE = 0.3
#: Words of a shingle, and shares of question and answer shingles that a leak has.
SHINGLE = 5
QUESTION, ANSWER = 0.8, 0.5
#: Items of a posting block, and bytes of item texts in one index (which is broadcast).
POSTINGS = 8
INDEX_BYTES = 4 << 20
_EDGE = re.compile(rb"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")


def _term(word: bytes) -> bytes:
    """A word without the ASCII punctuation around it; the word itself if nothing else is left."""
    return _EDGE.sub(b"", word) or word


def split_words(text: str | None) -> list[bytes]:
    """Words in lower case."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def question_and_answer(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Terms of the item's last line, or of its last sentence, and of what stands before it.

    An item of one sentence is all question.
    """
    body = (text or "").strip()
    cut = max(body.rfind("\n"), body.rfind(". ", 0, len(body) - 1))
    question, answer = (body[: cut + 1], body[cut + 1 :]) if cut > 0 else (body, "")
    return [_term(w) for w in split_words(question)], [_term(w) for w in split_words(answer)]


def _shingles(words: list[bytes]) -> set[tuple[bytes, ...]]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


@dataclass
class Index:
    """Postings of a block of items.  Scores are shares of the item's own score, so one threshold fits all.

    ``terms`` numbers the words; ``start``/``items``/``impact`` are the postings.  ``high_*`` are
    those of looked-up terms by posting block with the largest impact there, and ``need`` what a
    block's looked-up terms must add to for any of its items to reach the threshold.
    """

    ids: list
    questions: list[set]
    answers: list[set]
    terms: dict[bytes, int]
    start: np.ndarray
    items: np.ndarray
    impact: np.ndarray
    high_start: np.ndarray
    high_block: np.ndarray
    high_impact: np.ndarray
    need: np.ndarray
    passage: int

    @staticmethod
    def build(rows: list[tuple], df: dict[bytes, int], n_items: int, mean_length: float, common: dict[bytes, int]) -> Index:
        """``rows``: (item id, text); ``df``: items that have a term; ``common``: how common it is."""
        ids, questions, answers, longest = [], [], [], 1
        terms: dict[bytes, int] = {}
        postings: list[list[tuple[int, float]]] = []
        need_of: list[float] = []
        idle: list[set] = []
        for item_id, text in rows:
            question, answer = question_and_answer(text)
            words = question + answer
            if not words:
                continue
            counts, number = Counter(words), len(ids)
            longest = max(longest, len(words))
            scores = {}
            for t, tf in counts.items():
                idf = log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5))
                scores[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
            total = sum(scores.values())
            held, skipped = 0.0, set()
            for t in sorted(scores, key=lambda t: (-common.get(t, 0), t)):
                if held + scores[t] / total > IDLE:
                    break
                held += scores[t] / total
                skipped.add(t)
            for t, s in scores.items():
                at = terms.setdefault(t, len(terms))
                if at == len(postings):
                    postings.append([])
                postings[at].append((number, s / total))
            ids.append(item_id)
            questions.append(_shingles(question))
            answers.append(_shingles(answer))
            need_of.append(SHARE - held)
            idle.append(skipped)
        names = list(terms)
        blocks = -(-len(ids) // POSTINGS)
        need = np.full(max(1, blocks), np.inf)
        for number, x in enumerate(need_of):
            need[number // POSTINGS] = min(need[number // POSTINGS], x)
        high: list[dict[int, float]] = []
        for t, own in zip(names, postings, strict=True):
            most: dict[int, float] = defaultdict(float)
            for number, s in own:
                if t not in idle[number]:
                    most[number // POSTINGS] = max(most[number // POSTINGS], s)
            high.append(most)
        flat = [x for own in postings for x in own]
        flat_high = [x for own in high for x in own.items()]
        return Index(
            ids,
            questions,
            answers,
            terms,
            np.cumsum([0, *map(len, postings)]),
            np.array([x[0] for x in flat], np.int64),
            np.array([x[1] for x in flat]),
            np.cumsum([0, *map(len, high)]),
            np.array([x[0] for x in flat_high], np.int64),
            np.array([x[1] for x in flat_high]),
            need,
            max(64, 2 * longest),
        )

    def _added(self, rows: np.ndarray, terms: np.ndarray, n_rows: int, start: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
        """Sums of the postings of (row, term) pairs, as rows x width."""
        lengths = start[terms + 1] - start[terms]
        places = np.arange(lengths.sum()) + np.repeat(start[terms] - np.cumsum(lengths) + lengths, lengths)
        cells = np.repeat(rows, lengths) * width + columns[places]
        return np.bincount(cells, values[places], n_rows * width).reshape(n_rows, width)

    def retrieved(self, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, float]]:
        """(document, first word of the passage, item, score share) for all at or above the threshold.

        A document is its words' term numbers, -1 for words of no item.  Passages are ``passage``
        words long and start every half of that, so an item's words stand together in one of them.
        Looked-up terms are added by posting block first; only passages in which some block can
        reach the threshold are scored, over all terms.
        """
        half, n_items = self.passage // 2, len(self.ids)
        lengths = np.array([len(d) for d in documents])
        flat = np.concatenate(documents)
        owner = np.repeat(np.arange(len(documents)), lengths)
        within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        halves = -(-lengths // half)
        first = np.cumsum(halves) - halves  # passage k of a document has its halves k and k + 1
        known = np.flatnonzero(flat >= 0)
        own, terms = first[owner[known]] + within[known] // half, flat[known]
        n = int(halves.sum())
        pairs = np.unique(own * len(self.terms) + terms)  # a term counts once in each half
        own, terms = pairs // len(self.terms), pairs % len(self.terms)
        busy = self.high_start[terms + 1] > self.high_start[terms]
        width = len(self.need)
        for a in range(0, n, 4096):
            b = min(n, a + 4096)
            inside = slice(*np.searchsorted(own, [a, min(n, b + 1)]))
            rows, t, high = own[inside] - a, terms[inside], busy[inside]
            size = min(n, b + 1) - a
            bound = self._added(rows[high], t[high], size, self.high_start, self.high_block, self.high_impact, width)
            both = bound.copy()
            both[:-1] += bound[1:]
            able = np.flatnonzero((both[: b - a] >= self.need - 1e-9).any(axis=1))
            if not len(able):
                continue
            # every half in question with its terms, then each passage's distinct terms
            starts, ends = np.searchsorted(rows, able), np.searchsorted(rows, able + 2)
            document = np.searchsorted(first, able + a, side="right") - 1
            last = first[document] + halves[document] - 1
            ends = np.where(able + a < last, ends, np.searchsorted(rows, able + 1))
            number = ends - starts
            places = np.arange(number.sum()) + np.repeat(starts - np.cumsum(number) + number, number)
            keys = np.unique(np.repeat(np.arange(len(able)), number) * len(self.terms) + t[places])
            scores = self._added(keys // len(self.terms), keys % len(self.terms), len(able), self.start, self.items, self.impact, n_items)
            for k, item in zip(*np.nonzero(scores >= SHARE - 1e-9), strict=True):
                yield int(document[k]), int((able[k] + a - first[document[k]]) * half), int(item), float(scores[k, item])

    def overlap(self, words: list[bytes], item: int) -> tuple[float, float]:
        """Shares of the item's question and answer shingles that a passage has; 1 where there are none."""
        found = []
        for own in (self.questions[item], self.answers[item]):
            sizes = {len(s) for s in own}
            there = {tuple(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)}
            found.append(len(own & there) / len(own) if own else 1.0)
        return found[0], found[1]


class _Numbers(dict):
    """Term numbers of words as they stand, remembered up to a bound."""

    def __init__(self, terms: dict[bytes, int]):
        super().__init__(terms)
        self.terms = terms

    def __missing__(self, word: bytes) -> int:
        number = self.terms.get(_term(word), -1)
        if len(self) < 400_000:
            self[word] = number
        return number


def _asked(index_of):
    """For each row: its leaks, one for each item, by the best passage."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = index_of()
        numbers = _Numbers(index.terms)
        for part in parts:
            ids, texts = part["doc_id"].tolist(), part["text"].tolist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and size < 2_000_000:
                    size += len(texts[end] or "")
                    end += 1
                words = [split_words(t) for t in texts[at:end]]
                codes = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
                best: dict[tuple[int, int], tuple] = {}
                for document, first, item, score in index.retrieved(codes):
                    passage = [_term(w) for w in words[document][first : first + index.passage]]
                    question, answer = index.overlap(passage, item)
                    row = (question >= QUESTION and answer >= ANSWER, score, question, answer)
                    if best.get((document, item), (False, -1.0))[:2] < row[:2]:
                        best[document, item] = row
                out = [(ids[at + d], index.ids[i], s, q, a, ok) for (d, i), (ok, s, q, a) in best.items()]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "leak"])
                at = end

    return run


def retrieved_items(docs: DataFrame, items: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, leak`` for every item that a passage retrieves."""
    out = _retrieved(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"), items, index_bytes)
    return out.withColumns({"doc_id": F.col("doc_id").cast("long"), "item_id": F.col("item_id").cast("long")})


def _retrieved(docs: DataFrame, items: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The same with ids as text.

    Items are dealt by a hash to as many indexes as their texts need at ``index_bytes`` each, a
    size that is summed before anything is collected; every index is broadcast and asked with
    all passages, one pass for each.  Document frequencies are those of all items.  Which terms
    are not looked up follows how many items have them, and only saves work: no result hangs on it.
    """
    spark = docs.sparkSession
    rows = docs.where("text IS NOT NULL")
    items = written(items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL"), "test-items")

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for text in part["text"]:
                question, answer = question_and_answer(text)
                words = question + answer
                yield pd.DataFrame({"term": sorted(set(words)), "n": len(words)})

    size = items.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    blocks = max(1, ceil((size["bytes"] or 0) / index_bytes))
    terms = written(items.select("text").mapInPandas(split, "term binary, n long").groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("n")), "test-terms")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    held = written(items.withColumn("block", block), "test-blocks")
    words = held.select("text").mapInPandas(lambda parts: (pd.DataFrame({"n": [len(split_words(t)) for t in p["text"]]}) for p in parts), "n long")
    mean = words.agg(F.avg("n")).first()[0] or 1.0
    out = None
    for k in range(blocks):
        own = [(r["item_id"], r["text"]) for r in held.where(F.col("block") == k).orderBy("item_id", "text").collect()]  # index_bytes at most, about
        used = {t for _, text in own for part in question_and_answer(text) for t in part}
        if blocks == 1:
            df = {bytes(r["term"]): r["df"] for r in terms.collect()}
        else:
            mine = spark.createDataFrame([(bytearray(t),) for t in used], "term binary")
            df = {bytes(r["term"]): r["df"] for r in terms.join(F.broadcast(mine), "term").collect()}
        if not used:
            continue
        shared = spark.sparkContext.broadcast(Index.build(own, df, size["n"], mean, df))
        found = rows.mapInPandas(_asked(lambda shared=shared: shared.value), "doc_id string, item_id string, score double, question_overlap double, answer_overlap double, leak boolean")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "doc_id string, item_id string, score double, question_overlap double, answer_overlap double, leak boolean")
    return out


def leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Pairs of a document and a test item that it contains: ``doc_id, item_id, score, question_overlap, answer_overlap``.

    Words are compared in lower case without the punctuation around them.  A pair needs a passage
    that reaches 60 % of the item's own BM25 score and has 80 % of its question's five-word
    shingles and half of its answer's.  Null and empty texts, and items without words, match
    nothing; repeated rows each give their pairs, and items of one text each give a pair.
    """
    return retrieved_items(docs, items, **options).where("leak").drop("leak")


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without a leak; rows with a null id can't be told apart and stay."""
    found = leaks(docs, items, **options).select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
    own = packed(docs, _own=F.col("doc_id"))
    return own.join(found, F.col("_own") == F.col("_id"), "left_anti").select("_row.*")


def clean_rows(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose own text has no leak, whatever their id: null, or that of other rows too."""
    key = F.concat_ws(":", F.xxhash64("text").cast("string"), F.col("doc_id").cast("string"))
    found = _retrieved(docs.select(key.alias("doc_id"), "text"), items, **options).where("leak").select(F.col("doc_id").alias("_id")).distinct()
    own = packed(docs, _own=key)
    return own.join(found, F.col("_own") == F.col("_id"), "left_anti").select("_row.*")
