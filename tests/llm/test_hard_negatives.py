"""Zone maps and windows against scores of every anchor with every row."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tunetables.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = [max(-H.MOST, min(H.MOST, math.floor(256 * float(np.float32(x))))) for x in v]
        good.append((i, (label + 1) % 10 if i % 7 == 0 else label, own))
    out = []
    for at, (i, label, v) in enumerate(good):
        if i % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=False)), j, own) for k, (j, own, w) in enumerate(good) if k != at]
        scores.sort(key=lambda s: s[:2])
        for p, positive, _ in [s for s in scores if s[2] == label][:positives]:
            found = [(n, j) for n, j, own in scores if own != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, positive, rank, j, -p, -n) for rank, (n, j) in enumerate(found[:negatives], 1)]
    return sorted(out)


def cases(rng, n=900, dims=12):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(15)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in rng.choice(centres)], rng.randrange(10)) for i in range(n)]
    copied = rows[100][1]
    rows += [(1000 + i, copied, 3) for i in range(300)]
    rows += [rows[50], (None, copied, 1), (2001, None, 1), (2002, copied, None), (2003, [None, *copied[1:]], 1), (2004, [float("nan"), *copied[1:]], 1)]
    rows += [(2050, [float("inf")], 1), (2100, [], 2), (2150, [0.5], 3), (2200, [0.0] * dims, 4), (2300, [1e30, -1e30], 5), (-50, copied, 0), (-7, copied, 9)]
    return rows


def test_equal_all_scores(spark):
    rows = cases(random.Random(8))
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS row", "'y' AS v", "1 AS tile", "2 AS score", "3 AS block")
    found = H.hard_negatives(df.repartition(6))
    assert [f.dataType.simpleString() for f in found.schema.fields] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    want = brute(rows)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 150
    # many small blocks and tiles
    small = H.hard_negatives(df, block_bytes=4 * 12 * 16, tile_bytes=4 * 12 * 5)
    assert sorted(map(tuple, small.collect())) == want


def test_bounds_choose_few_blocks_of_clusters(spark):
    """Of rows in clusters, zones leave out most blocks, and none with a row in a window."""
    rng = random.Random(2)
    centres = [[rng.choice([-1.0, 1.0]) * rng.uniform(0.4, 1) for _ in range(6)] for _ in range(20)]
    rows = spark.createDataFrame([(i, [c + rng.gauss(0, 0.02) for c in centres[i % 20]], i % 3) for i in range(4000)], SCHEMA)
    clean = H.written(H.usable_rows(rows), "rows")
    space = H.Space(6, -400, 400)
    blocks = H.curve_blocks(clean, space, 32)
    tiles = H.curve_blocks(clean.where("vec_id % 400 = 0"), space, 1)
    anchors = tiles.drop("low", "high").withColumnRenamed("block", "tile")
    windows = H._places(tiles).selectExpr("tile", "anchor AS window", "anchor", "250000L AS low", "400000L AS high", "-1L AS floor")
    chosen = H.chosen_blocks(blocks, H._with_windows(anchors, windows), space, seeds=False)
    assert chosen.count() < 0.5 * blocks.count() * tiles.count()


def test_bounds_hold():
    rng = np.random.default_rng(0)
    vectors, anchors = rng.integers(-300, 300, (40, 9)), rng.integers(-300, 300, (25, 9))
    least, greatest = H.score_bounds(anchors, vectors.min(axis=0)[None], vectors.max(axis=0)[None])
    scores = anchors @ vectors.T
    assert (least <= scores.min(axis=1, keepdims=True)).all() and (greatest >= scores.max(axis=1, keepdims=True)).all()
    far = np.full((2, 3), H.MOST)
    assert (H._dot(far, far) == 3 * H.MOST * H.MOST).all()


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 4), (3, 3), (5, 2), (4, 1)])
def test_the_curve_visits_neighbours(dims, bits):
    """Every point has its own place, and points at places in a row are one step apart."""
    side = np.arange(1 << bits)
    grid = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = [k.tobytes() for k in H.hilbert_keys(grid, bits)]
    assert len(set(keys)) == len(grid)
    walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_nothing_to_mine(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert H.hard_negatives(spark.createDataFrame([(50, [1.0], 1), (2, [0.9], 2)], SCHEMA)).collect() == []
    assert H.hard_negatives(spark.createDataFrame([(50, [], 1), (1, [], 1), (2, [], 2)], SCHEMA)).collect() == [(50, 1, 1, 2, 0, 0)]
