"""Ranked lexical search: the best documents of each item, found by a dual tree over items and documents.

Items and documents are vectors over the items' terms without negative coordinates, and a score is their
inner product.  Both sides are put in hierarchies whose nodes hold the greatest value of each coordinate
below them, so the product of two nodes bounds every score between them.  A pair of nodes whose bound
is below the weakest k-th score of the node's items is left out, whole batches of documents included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import floor, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetables.session import is_small, written

K = 10
#: Children of a node, documents of a leaf, and documents or term entries of a batch at most.
FANOUT, LEAF, BATCH, BATCH_ENTRIES = 8, 32, 2048, 1 << 20
#: Bytes of item texts searched in one pass over the documents; they and their terms are what tasks hold.
ITEM_BYTES = 8 << 20
#: Products of item entries with documents formed at once.
PRODUCTS = 1 << 21
#: Batches read first for each item, to have k-th scores to prune with.
SEEDS = 2
#: Terms are runs of letters, digits and all beyond ASCII, in UTF-8; only A-Z are lower-cased.
_SEEN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """
    >>> terms_of("It's A_1 É")
    [b'it', b's', b'a', b'1', b'\\xc3\\x89']
    """
    return (text or "").encode("utf-8", "surrogatepass").translate(_SEEN).split()


def _places(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all entries of some rows, and where each row begins among them."""
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - first, lengths), first


@dataclass
class Rows:
    """Sparse non-negative vectors, none of them empty: ``starts`` has one more entry than there are rows."""

    starts: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def maxima(self, group: int) -> Rows:
        """The greatest value of each coordinate over runs of ``group`` rows."""
        owner = np.repeat(np.arange(len(self)) // group, np.diff(self.starts))
        order = np.lexsort((self.terms, owner))
        owner, terms = owner[order], self.terms[order]
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])]))
        values = np.maximum.reduceat(self.values[order], first)
        starts = np.searchsorted(owner[first], np.arange(-(-len(self) // group) + 1))
        return Rows(starts, terms[first], values)

    def products(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner products of some rows with a dense vector."""
        at, first = _places(self.starts[rows], self.starts[rows + 1])
        return np.add.reduceat(self.values[at] * dense[self.terms[at]], first)

    def tree(self, leaf: int) -> list[Rows]:
        """Maxima over runs of ``leaf`` rows, over ``FANOUT`` of these, and so on up to one node."""
        levels = [self.maxima(leaf)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].maxima(FANOUT))
        return levels


@dataclass
class Items:
    """Items as vectors of term weights, with their tree; ``names`` are the item ids, which may repeat."""

    names: list
    rows: Rows
    n_terms: int
    levels: list[Rows] = field(init=False)

    def __post_init__(self) -> None:
        self.levels = [self.rows]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].maxima(FANOUT))


class Search:
    """The best documents of each item among the batches that it is shown."""

    def __init__(self, items: Items, k: int, kth: np.ndarray | None = None):
        self.items, self.k = items, k
        self.best: list[list[tuple]] = [[] for _ in items.names]
        self.dense = np.zeros(items.n_terms, np.int64)
        self.column = np.zeros(items.n_terms, np.int64)
        #: Weakest k-th score of each node; scores of 0 never count.
        self.weakest = [np.ones(len(items.names), np.int64) if kth is None else np.maximum(kth, 1)]
        for level in items.levels[1:]:
            below = self.weakest[-1]
            self.weakest.append(np.minimum.reduceat(below, np.arange(len(level)) * FANOUT))

    def able(self, level: int, nodes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The nodes of the items' tree whose bound with a node of documents reaches their weakest k-th score."""
        self.dense[terms] = values
        bounds = self.items.levels[level].products(nodes, self.dense)
        self.dense[terms] = 0
        return nodes[bounds >= self.weakest[level][nodes]]

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Children of nodes of the items' tree."""
        children = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        return children[children < len(self.items.levels[level - 1])]

    def add(self, ids: list, docs: Rows) -> None:
        """Look at the documents of one batch."""
        tree = docs.tree(LEAF)
        top = len(self.items.levels) - 1
        waiting = [(len(tree) - 1, 0, top, np.arange(len(self.items.levels[top])))]
        while waiting:
            height, node, level, nodes = waiting.pop()
            part = slice(tree[height].starts[node], tree[height].starts[node + 1])
            terms, values = tree[height].terms[part], tree[height].values[part]
            nodes = self.able(level, nodes, terms, values)
            while len(nodes) and level and not height:
                level, nodes = level - 1, self.below(level, nodes)
                nodes = self.able(level, nodes, terms, values)
            if not len(nodes):
                continue
            if not height:
                self._score(ids, docs, node * LEAF, min(len(docs), (node + 1) * LEAF), nodes)
                continue
            if level:
                level, nodes = level - 1, self.below(level, nodes)
            last = min(len(tree[height - 1]), (node + 1) * FANOUT)
            waiting.extend((height - 1, child, level, nodes) for child in range(last - 1, node * FANOUT - 1, -1))

    def _score(self, ids: list, docs: Rows, first: int, last: int, items: np.ndarray) -> None:
        """Exact scores of a leaf's documents with some items."""
        rows, n = self.items.rows, last - first
        part = slice(docs.starts[first], docs.starts[last])
        terms, owner = docs.terms[part], np.repeat(np.arange(n), np.diff(docs.starts[first : last + 1]))
        used = np.unique(terms)
        self.column[used] = np.arange(1, len(used) + 1)
        table = np.zeros((n, len(used) + 1), np.int64)
        table[owner, self.column[terms]] = docs.values[part]
        sizes = np.cumsum(rows.starts[items + 1] - rows.starts[items])
        cuts = np.unique(np.searchsorted(sizes, np.arange(0, sizes[-1], max(1, PRODUCTS // n)), side="right"))
        for some in np.split(items, cuts[(cuts > 0) & (cuts < len(items))]):
            at, begin = _places(rows.starts[some], rows.starts[some + 1])
            scores = np.add.reduceat(table[:, self.column[rows.terms[at]]] * rows.values[at], begin, axis=1)
            reached = scores >= self.weakest[0][some]
            for j in np.flatnonzero(reached.any(axis=0)).tolist():
                found = np.flatnonzero(reached[:, j])
                self._keep(int(some[j]), [(int(scores[d, j]), ids[first + d]) for d in found.tolist()])
        self.column[used] = 0

    def _keep(self, item: int, found: list[tuple]) -> None:
        # higher scores first, equal ones by id, null ids last
        order = sorted(self.best[item] + found, key=lambda p: (-p[0], p[1] is None, p[1] or 0))
        self.best[item] = order[: self.k]
        if len(order) < self.k or order[self.k - 1][0] <= self.weakest[0][item]:
            return
        self.weakest[0][item] = order[self.k - 1][0]
        node = item
        for level in range(1, len(self.weakest)):
            node //= FANOUT
            least = self.weakest[level - 1][node * FANOUT : (node + 1) * FANOUT].min()
            if self.weakest[level][node] == least:
                break
            self.weakest[level][node] = least

    def found(self) -> pd.DataFrame:
        flat = [(i, *pair) for i, own in enumerate(self.best) for pair in own]
        return pd.DataFrame(
            {
                "item": pd.Series([f[0] for f in flat], dtype="int64"),
                "score": pd.Series([f[1] for f in flat], dtype="int64"),
                "doc_id": pd.array([f[2] for f in flat], dtype="Int64"),
            }
        )


def counted_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n`` (terms with repeats), and ``terms, tfs`` for the terms of the vocabulary."""

    def counted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            n, terms, tfs = [], [], []
            for text in part["text"].tolist():
                found = terms_of(text)
                counts = Counter(found)
                own = sorted((vocabulary[t], counts[t]) for t in counts.keys() & vocabulary.keys())
                n.append(len(found))
                terms.append(np.array([t for t, _ in own], np.int32))
                tfs.append(np.array([c for _, c in own], np.int32))
            yield pd.DataFrame({"doc_id": part["doc_id"], "n": n, "terms": terms, "tfs": tfs})

    # ids as texts, for null ones among long ones
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    rows = rows.mapInPandas(counted, "doc_id string, n long, terms array<int>, tfs array<int>")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).where("n > 0")


def _item_rows(collected: list) -> tuple[list, list[Counter]]:
    """Ids and term counts of items that have terms, neighbours being likely to share terms."""
    found = [(row["item_id"], Counter(terms_of(row["text"]))) for row in collected]
    found = [(name, counts) for name, counts in found if counts]
    spread = Counter(t for _, counts in found for t in counts)
    # first by the terms that most items share, which tell languages and subjects apart
    found.sort(key=lambda f: sorted(f[1], key=lambda t: (-spread[t], t))[:4])
    return [name for name, _ in found], [counts for _, counts in found]


def _batches(rows: DataFrame, weights: np.ndarray, n_docs: int, n_all: int) -> DataFrame:
    """Documents as coordinates, in batches of neighbours: one row each, with the batch's maxima as its zone."""
    commonest = np.argsort(np.argsort(weights, kind="stable")).astype(np.int32)

    def placed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            values, keys = [], []
            for n, terms, tfs in zip(part["n"].tolist(), part["terms"], part["tfs"], strict=True):
                m = 25 + 75 * n * n_docs // n_all
                tf = np.asarray(tfs, np.int64)
                own = 1_000_000_000 * tf // (1000 * tf + 8 * m)
                # neighbours share the commonest term, then the terms that score most
                strong = np.argsort(-own * weights[terms], kind="stable")[:2]
                values.append(own)
                keys.append([int(commonest[terms].min()), *(int(terms[s]) for s in strong), -1][:3])
            yield pd.DataFrame({"doc_id": part["doc_id"], "terms": part["terms"], "values": values, "key": keys})

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, terms, values, size = [], [], [], 0

        def batch() -> pd.DataFrame:
            rows = Rows(np.cumsum([0, *map(len, terms)]), np.concatenate(terms), np.concatenate(values))
            zone = rows.maxima(len(rows))
            blobs = {"starts": rows.starts, "terms": rows.terms, "values": rows.values, "zone_terms": zone.terms, "zone_values": zone.values}
            return pd.DataFrame({"ids": [[None if i is None else int(i) for i in ids]], **{k: [v.astype("<i4").tobytes()] for k, v in blobs.items()}})

        for part in parts:
            for i, t, v in zip(part["doc_id"].tolist(), part["terms"], part["values"], strict=True):
                if ids and (len(ids) == BATCH or size + len(t) > BATCH_ENTRIES):
                    yield batch()
                    ids, terms, values, size = [], [], [], 0
                ids.append(i)
                terms.append(np.asarray(t, np.int32))
                values.append(np.asarray(v, np.int64))
                size += len(t)
        if ids:
            yield batch()

    as_text = F.col("doc_id").cast("string").alias("doc_id")
    found = rows.where(F.size("terms") > 0).select(as_text, "n", "terms", "tfs")
    found = found.mapInPandas(placed, "doc_id string, terms array<int>, values array<long>, key array<int>")
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "coordinates")
    ways = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n_docs // (16 * BATCH)))
    # equal keys are spread by the row number
    sorted_rows = found.repartitionByRange(ways, "key", "row").sortWithinPartitions("key", "row")
    made = sorted_rows.select("doc_id", "terms", "values").mapInPandas(
        packed, "ids array<long>, starts binary, terms binary, values binary, zone_terms binary, zone_values binary"
    )
    return written(made.withColumn("batch", F.monotonically_increasing_id()), "batches")


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i4").astype(np.int64)


def _searched(batches: DataFrame, items: Items, k: int, kth: np.ndarray | None) -> DataFrame:
    """``item, score, doc_id``: the best of each item among the batches of each task."""

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Search(items, k, None if kth is None else kth.copy())
        for part in parts:
            for ids, starts, terms, values in zip(part["ids"], part["starts"], part["terms"], part["values"], strict=True):
                names = [None if i is None or i != i else int(i) for i in ids]
                own.add(names, Rows(_ints(starts), _ints(terms), _ints(values)))
        yield own.found()

    return batches.select("ids", "starts", "terms", "values").mapInPandas(search, "item long, score long, doc_id long")


def _bounded(batches: DataFrame, items: Items, kth: np.ndarray | None) -> DataFrame:
    """From zones alone: without ``kth`` each task's ``SEEDS`` most promising batches of each item
    (``item, bound, batch``); with it, one row for each batch that may hold one of the best."""

    def judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Search(items, 1, kth)
        every = np.arange(len(items.names))
        tops, of = np.zeros((SEEDS + 1, len(every)), np.int64), np.zeros((SEEDS + 1, len(every)), np.int64)
        for part in parts:
            able = []
            for batch, terms, values in zip(part["batch"].tolist(), part["zone_terms"], part["zone_values"], strict=True):
                terms, values = _ints(terms), _ints(values)
                if kth is not None:
                    level = len(items.levels) - 1
                    nodes = own.able(level, np.arange(len(items.levels[level])), terms, values)
                    while level and len(nodes):
                        level, nodes = level - 1, own.below(level, nodes)
                        nodes = own.able(level, nodes, terms, values)
                    able.append(batch) if len(nodes) else None
                    continue
                own.dense[terms] = values
                tops[SEEDS], of[SEEDS] = items.rows.products(every, own.dense), batch
                own.dense[terms] = 0
                order = np.argsort(-tops, axis=0, kind="stable")
                tops, of = np.take_along_axis(tops, order, 0), np.take_along_axis(of, order, 0)
            if able:
                yield pd.DataFrame({"item": 0, "bound": 0, "batch": able})
        place, item = np.nonzero(tops[:SEEDS])
        yield pd.DataFrame({"item": item, "bound": tops[place, item], "batch": of[place, item]})

    return batches.select("batch", "zone_terms", "zone_values").mapInPandas(judged, "item long, bound long, batch long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _of(batches: DataFrame, chosen: DataFrame) -> DataFrame:
    chosen = chosen.select("batch").distinct()
    return batches.join(F.broadcast(chosen) if is_small(chosen) else chosen, "batch", "left_semi")


def _ranked_piece(docs: DataFrame, collected: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    names, counts = _item_rows(collected)
    if not names:
        return None
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for own in counts for t in sorted(own)))}
    rows = written(counted_documents(docs, vocabulary), "term-counts")
    size = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not size["docs"]:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    # one row for each term of the items at most
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    weights = np.array([floor(1000 * log((2 * size["docs"] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    starts = np.cumsum([0, *map(len, counts)])
    terms = np.array([vocabulary[t] for own in counts for t in own], np.int64)
    repeats = np.array([n for own in counts for n in own.values()], np.int64)
    items = Items(names, Rows(starts, terms, repeats * weights[terms]), len(vocabulary))
    batches = _batches(rows, weights, size["docs"], size["terms"])
    best = Window.partitionBy("item").orderBy(F.col("bound").desc(), "batch")
    first = _bounded(batches, items, None).withColumn("place", F.row_number().over(best)).where(F.col("place") <= SEEDS)
    seeds = _top(_searched(_of(batches, written(first, "seeds")), items, k, None), k)
    kth = np.zeros(len(names), np.int64)
    # one number for each item
    for item, score in seeds.where(F.col("rank") == k).select("item", "score").collect():
        kth[item] = score
    able = written(_bounded(batches, items, kth), "able-batches")
    found = _top(_searched(_of(batches, able), items, k, kth), k)
    table = spark.createDataFrame([(i, name) for i, name in enumerate(names)], "item long, item_id long")
    return found.join(F.broadcast(table), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, higher scores first.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns, whatever their names, are not
    read.  Null and empty texts have no terms: such documents count nowhere and such items have no rows.
    Very long texts are read whole.  Equal scores are ranked by id, null ids last; repeated rows of either
    table are rows of their own.  Empty tables give no rows, and so do items that share no term
    with any document.  Items are searched in pieces of at most about ``item_bytes`` of their texts (one longer
    item is a piece of its own), each with its own pass over the documents.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = 1 if total <= item_bytes else -(-2 * total // item_bytes)
    if pieces > 1:
        asked = written(asked.withColumn("piece", F.pmod(F.monotonically_increasing_id(), F.lit(pieces))), "items")
    found = []
    for piece in range(pieces):
        own = asked if pieces == 1 else asked.where(F.col("piece") == piece)
        found.append(_ranked_piece(docs, own.collect(), k))
    found = [f for f in found if f is not None]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
