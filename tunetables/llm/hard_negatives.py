"""Hard negatives: rows of other labels whose score lies in a window below a positive's, found by zone maps.

Rows are laid along a Hilbert curve and cut into Parquet blocks that keep the least and greatest value
of each dimension.  For an anchor and a block, interval arithmetic over these zones gives the least
and greatest score that any row of the block can have; only blocks whose interval meets a window
above its provisional k-th score are joined to the anchor's tile and scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetables.session import written

POSITIVES, NEGATIVES = 5, 3
#: Percent of a positive's score that a negative's reaches at least and at most.
LOWEST, HIGHEST = 50, 95
#: Bits of a dimension on the curve, and bytes of a key that order rows.
BITS, KEY_BYTES = 4, 64
#: Bytes of vectors in a block and in a tile of anchors; at 64 dimensions 256 rows and 4,096 anchors.
BLOCK_BYTES, TILE_BYTES = 1 << 16, 1 << 20
#: Zones judged in one group, blocks read in one group, and blocks read first by each tile and group of zones.
ZONES, SHELF, SEEDS = 4096, 64, 4
#: Components are held within these bounds (2^18 as a component), so that scores fit in 64 bits.
MOST = 1 << 26
NONE, ALL = -(1 << 62), 1 << 62


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each grid point on the Hilbert curve, as big-endian bytes (Skilling's transform, 2004).

    ``grid`` has a row for each point with a number below ``2 ** bits`` for each dimension.
    """
    x = grid.astype(np.int64).T.copy()
    n = len(x)
    if not n:
        return np.zeros((grid.shape[0], 0), np.uint8)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level & 1).astype(bool)
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swapped)
            x[i] ^= swapped if i else 0
    for i in range(1, n):
        x[i] ^= x[i - 1]
    last = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        last ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= last
    planes = np.stack([x >> level & 1 for level in range(bits - 1, -1, -1)])
    return np.packbits(planes.transpose(2, 0, 1).reshape(x.shape[1], -1).astype(np.uint8), axis=1)


def usable_rows(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v, row``: labels after the shift, components times 256 rounded down, a number of each row.

    Rows with a null id, label or vector, or a component that is null or not finite, are left out.
    """
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform(
        "embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * 256, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int")
    )
    label = F.col("label").cast("long")
    return (
        rows.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull())
        .where(finite)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
            scaled.alias("v"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


@dataclass
class Space:
    """Dimensions of the vectors and the range of their components."""

    dims: int
    least: int
    greatest: int

    def matrix(self, vectors) -> np.ndarray:
        """Vectors as rows; missing components are 0."""
        out = np.zeros((len(vectors), self.dims), np.int64)
        for own, v in zip(out, vectors, strict=True):
            own[: len(v)] = v
        return out


def curve_blocks(rows: DataFrame, space: Space, size: int) -> DataFrame:
    """Blocks of up to ``size`` rows that are neighbours on the curve, one row each: ids, labels, row numbers,
    vectors, and the least and greatest value of every dimension."""
    n_rows = rows.count()

    def keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            m = space.matrix(part["v"])
            grid = ((m - space.least) << BITS) // (space.greatest - space.least + 1)
            keys = hilbert_keys(np.clip(grid, 0, (1 << BITS) - 1))[:, :KEY_BYTES]
            yield pd.DataFrame(
                {
                    "key": [k.tobytes() for k in keys],
                    "vec_id": part["vec_id"],
                    "label": part["label"],
                    "row": part["row"],
                    "vector": [v.astype("<i4").tobytes() for v in m],
                }
            )

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            held = part if held is None else pd.concat([held, part], ignore_index=True)
            while len(held) >= size:
                yield block(held[:size])
                held = held[size:]
        if held is not None and len(held):
            yield block(held)

    def block(own: pd.DataFrame) -> pd.DataFrame:
        vectors = _ints(b"".join(own["vector"])).reshape(len(own), space.dims)
        blobs = {c: own[c].to_numpy().astype("<i8").tobytes() for c in ("vec_id", "label", "row")}
        blobs |= {"vectors": vectors, "low": vectors.min(axis=0), "high": vectors.max(axis=0)}
        return pd.DataFrame({k: [b if isinstance(b, bytes) else b.astype("<i4").tobytes()] for k, b in blobs.items()})

    ways = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, -(-n_rows // size)), -(-n_rows // (SHELF * size)))
    found = rows.select("vec_id", "label", "row", "v").mapInPandas(keyed, "key binary, vec_id long, label long, row long, vector binary")
    # rows at one place of the curve are spread by their number
    found = found.repartitionByRange(ways, "key", "row").sortWithinPartitions("key", "row").drop("key")
    made = found.mapInPandas(cut, "vec_id binary, label binary, row binary, vectors binary, low binary, high binary")
    return written(made.withColumn("block", F.monotonically_increasing_id()), "curve-blocks")


def _numbers(n: int) -> Column:
    """The numbers below ``n``."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _dealt(name: str, n: int) -> Column:
    """One of the numbers below ``n``, by hash."""
    return F.pmod(F.xxhash64(name), F.lit(n)).cast("long")


def _ints(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i4").astype(np.int64)


def _longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i8").astype(np.int64)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two integer matrices."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with any vector between ``low`` and ``high`` of each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _dot(up, low) + _dot(down, high), _dot(up, high) + _dot(down, low)


class Tile:
    """Anchors with their windows: scores from ``low`` to ``high``, of which those below ``floor`` cannot count."""

    def __init__(self, row, space: Space):
        self.vectors = _ints(row.vectors).reshape(-1, space.dims) if space.dims else np.zeros((len(row.row) // 8, 0), np.int64)
        self.label, self.row = _longs(row.label), _longs(row.row)
        self.window, self.anchor, self.low, self.high, self.floor = (np.array(row[c], np.int64) for c in ("window", "anchor", "low", "high", "floor"))

    def needs(self, least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        """Which windows (rows) must read which blocks (columns)."""
        enough = np.maximum(self.low, self.floor)[:, None]
        return (greatest[self.anchor] >= enough) & (least[self.anchor] <= self.high[:, None])


def _zones(zones: pd.DataFrame, space: Space) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, len(zones), 128):
        part = zones[at : at + 128]
        yield part["block"].to_numpy(), *(_ints(b"".join(part[c])).reshape(len(part), space.dims) for c in ("low", "high"))


def _tiles(tiles: pd.DataFrame, space: Space) -> Iterator[tuple[int, Tile]]:
    for _, row in tiles.rename(columns={"w_low": "low", "w_high": "high"}).iterrows():
        yield row["tile"], Tile(row, space)


def chosen_blocks(blocks: DataFrame, tiles: DataFrame, space: Space, seeds: bool) -> DataFrame:
    """``tile, block``: from zones alone, the blocks that some window of a tile must read.

    With ``seeds``, instead the ``SEEDS`` blocks of each group of zones that have the greatest bound for most anchors.
    """
    n_blocks, n_tiles = blocks.count(), tiles.count()
    parts, ways = max(1, -(-n_blocks // ZONES)), max(1, n_tiles)

    def choose(tiles: pd.DataFrame, zones: pd.DataFrame) -> pd.DataFrame:
        found = []
        for number, tile in _tiles(tiles, space):
            best, of = np.full(len(tile.vectors), NONE), np.full(len(tile.vectors), -1)
            for block, low, high in _zones(zones, space):
                least, greatest = score_bounds(tile.vectors, low, high)
                if not seeds:
                    found.extend((number, b) for b in block[tile.needs(least, greatest).any(axis=0)].tolist())
                    continue
                top = greatest.argmax(axis=1)
                own = greatest[np.arange(len(top)), top]
                of, best = np.where(own > best, block[top], of), np.maximum(own, best)
            if seeds and len(zones):
                most, times = np.unique(of, return_counts=True)
                found.extend((number, b) for b in most[np.argsort(-times, kind="stable")[:SEEDS]].tolist())
        return pd.DataFrame(found, columns=["tile", "block"], dtype="int64")

    zones = blocks.select("block", "low", "high", _dealt("block", parts).alias("part"))
    zones = zones.withColumn("way", F.explode(_numbers(ways)))
    asked = tiles.withColumn("way", _dealt("tile", ways))
    asked = asked.withColumn("part", F.explode(_numbers(parts)))
    return asked.groupBy("part", "way").cogroup(zones.groupBy("part", "way")).applyInPandas(choose, "tile long, block long")


def best_in_blocks(blocks: DataFrame, tiles: DataFrame, chosen: DataFrame, space: Space, k: int, same: bool) -> DataFrame:
    """``tile, window, score, vec_id, place``: the ``k`` best rows in each window among the chosen blocks,
    of the anchor's label (the anchor itself apart) or of another; equal scores by ``vec_id``."""
    shelves = max(1, -(-blocks.count() // SHELF))

    def read(key: tuple, tiles: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("tile", "window", "score", "vec_id")})
        for number, tile in _tiles(tiles, space):
            windows = np.arange(len(tile.window))
            # window, score, id of the best so far
            held = np.zeros((3, 0), np.int64)
            for block in _by_bound(tile, blocks, space):
                wanted = windows[tile.needs(*block["bounds"])[:, 0]]
                if not len(wanted):
                    continue
                needed, at = np.unique(tile.anchor[wanted], return_inverse=True)
                scores = _dot(tile.vectors[needed], block["vectors"])
                alike = tile.label[needed][:, None] == block["label"]
                able = alike & (tile.row[needed][:, None] != block["row"]) if same else ~alike
                own = scores[at]
                fits = able[at] & (own >= np.maximum(tile.low, tile.floor)[wanted][:, None]) & (own <= tile.high[wanted][:, None])
                w, c = np.nonzero(fits)
                held = np.concatenate([held, np.stack([wanted[w], own[w, c], block["vec_id"][c]])], axis=1)
                held = held[:, np.lexsort((held[2], -held[1], held[0]))]
                place = np.arange(held.shape[1]) - np.searchsorted(held[0], held[0])
                held = held[:, place < k]
                last = held[:, place[place < k] == k - 1]
                tile.floor[last[0]] = np.maximum(tile.floor[last[0]], last[1])
            return pd.DataFrame({"tile": np.full(held.shape[1], number), "window": tile.window[held[0]], "score": held[1], "vec_id": held[2]})
        return none

    def _by_bound(tile: Tile, blocks: pd.DataFrame, space: Space) -> Iterator[dict]:
        """Blocks with the greatest bounds first."""
        made = []
        for _, row in blocks.iterrows():
            low, high = _ints(row["low"])[None], _ints(row["high"])[None]
            made.append((score_bounds(tile.vectors, low, high), row))
        made.sort(key=lambda m: -m[0][1].max(initial=NONE))
        for bounds, row in made:
            own = {c: _longs(row[c]) for c in ("vec_id", "label", "row")}
            yield own | {"bounds": bounds, "vectors": _ints(row["vectors"]).reshape(len(own["row"]), space.dims)}

    wanted = chosen.join(blocks, "block").withColumn("shelf", _dealt("block", shelves))
    shelved = tiles.withColumn("shelf", F.explode(_numbers(shelves)))
    found = shelved.groupBy("tile", "shelf").cogroup(wanted.groupBy("tile", "shelf")).applyInPandas(read, "tile long, window long, score long, vec_id long")
    order = Window.partitionBy("tile", "window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _places(tiles: DataFrame) -> DataFrame:
    """``tile, anchor, anchor_id``: which id stands at which place of a tile."""

    def listed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for tile, blob in zip(part["block"], part["vec_id"], strict=True):
                ids = _longs(blob)
                yield pd.DataFrame({"tile": tile, "anchor": np.arange(len(ids)), "anchor_id": ids})

    return tiles.select("block", "vec_id").mapInPandas(listed, "tile long, anchor long, anchor_id long")


def _with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Tiles with their windows as arrays; ``windows`` has ``tile, window, anchor, low, high, floor``."""
    fields = ("window", "anchor", "low", "high", "floor")
    packed = windows.groupBy("tile").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("w"))
    names = {"low": "w_low", "high": "w_high"}
    packed = packed.select("tile", *[F.col(f"w.{f}").alias(names.get(f, f)) for f in fields])
    return anchors.join(packed, "tile")


def best_in_windows(blocks: DataFrame, anchors: DataFrame, windows: DataFrame, space: Space, k: int, same: bool) -> DataFrame:
    """The ``k`` best rows in each window: first some promising blocks for provisional k-th scores, then
    all blocks whose bounds reach them."""
    tiles = _with_windows(anchors, windows)
    seeds = written(chosen_blocks(blocks, tiles, space, seeds=True), "seed-blocks")
    first = best_in_blocks(blocks, tiles, seeds, space, k, same)
    kth = first.where(F.col("place") == k).select("tile", "window", F.col("score").alias("reached"))
    raised = windows.join(kth, ["tile", "window"], "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached")
    tiles = written(_with_windows(anchors, raised), "tiles")
    chosen = written(chosen_blocks(blocks, tiles, space, seeds=False), "chosen-blocks")
    return best_in_blocks(blocks, tiles, chosen, space, k, same)


def hard_negatives(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = 50, block_bytes: int = BLOCK_BYTES, tile_bytes: int = TILE_BYTES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, embedding, label``; other columns, whatever their names, are not read.  Anchors are rows whose
    id is divisible by ``every``; their positives are the ``positives`` best other rows of the same label.
    A row with a null id takes no part either, as it can't be named.  Vectors of different lengths are compared as if
    missing components were 0, and components beyond 2^18 count as 2^18.  Repeated rows are rows of their own, so
    a repeated anchor gives its rows again; ties go by id.  Without anchors, positives or rows in a
    window there are no rows, and an empty table gives an empty one.
    """
    spark = rows.sparkSession
    clean = written(usable_rows(rows), "usable-rows")
    size = clean.agg(F.max(F.size("v")).alias("dims"), F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("greatest")).first()
    if size["dims"] is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    space = Space(size["dims"], min(0, size["least"] or 0), max(0, size["greatest"] or 0))
    row_bytes = 4 * max(1, space.dims)
    blocks = curve_blocks(clean, space, max(1, block_bytes // row_bytes))
    tiles = curve_blocks(clean.where(F.col("vec_id") % every == 0), space, max(1, tile_bytes // row_bytes))
    anchors = tiles.drop("low", "high").withColumnRenamed("block", "tile")
    places = _places(tiles)
    whole = places.select(
        "tile",
        F.col("anchor").alias("window"),
        "anchor",
        *[F.lit(v).cast("long").alias(c) for c, v in (("low", NONE), ("high", ALL), ("floor", NONE))],
    )
    found = best_in_windows(blocks, anchors, whole, space, positives, same=True)
    asked = written(
        # a negative score has no whole number between its shares
        found.where("score >= 0").select(
            "tile",
            (F.col("window") * positives + F.col("place") - 1).alias("window"),
            F.col("window").alias("anchor"),
            # the least and the greatest whole score of the window
            F.expr(f"(score * {LOWEST} + 99) div 100").alias("low"),
            F.expr(f"score * {HIGHEST} div 100").alias("high"),
            F.lit(NONE).cast("long").alias("floor"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    windows = asked.drop("positive_id", "positive_score")
    best = best_in_windows(blocks, anchors, windows, space, negatives, same=False)
    return (
        best.join(asked.select("tile", "window", "anchor", "positive_id", "positive_score"), ["tile", "window"])
        .join(places, ["tile", "anchor"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
