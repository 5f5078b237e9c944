"""Hard negatives against scoring every pair, and the bounds that prune."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registra.llm.hard_negatives import (
    HIGHEST,
    LOWEST,
    Bucket,
    Search,
    _bucket,
    directions,
    feasible,
    hard_negatives,
)

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=50, positives=5, negatives=3, least=50, most=95):
    def cells(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(np.float32(x))) for x in v]

    kept = {(i, y, tuple(c)) for i, v, y in rows if i is not None and y is not None
            for c in [cells(v)] if c is not None}
    out = []
    for a, y, v in kept:
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, z) for i, z, w in kept]
        near = sorted((s, i) for s, i, z in scored if z == y and i != a)[:positives]
        for s, p in near:
            far = sorted((t, i) for t, i, z in scored if z != y and -least * s <= -100 * t <= -most * s)
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n) in enumerate(far[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    ids, vectors, labels = zip(*rows) if rows else ((), (), ())
    table = pa.table(
        {
            "vec_id": pa.array(ids, pa.int64()),
            "embedding": pa.array(vectors, pa.list_(pa.float32())),
            "label": pa.array(labels, pa.int32()),
            "length": ["own"] * len(ids),
            "number": ["own"] * len(ids),
            "query": [None] * len(ids),
        },
    )
    df = spark.createDataFrame(table.set_column(5, "query", table["length"]))
    got = hard_negatives(df, F.col("vec_id") % 50 == 0, **options)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def cloud(seed, count, width=6, spread=0.3):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(4, width))
    lengths = rng.choice([0.2, 1, 1, 3], count)
    vectors = (middles[rng.integers(0, 4, count)] + spread * rng.normal(size=(count, width)))
    vectors *= (lengths / np.linalg.norm(vectors, axis=1))[:, None]
    return [(i, list(map(float, v)), int(y)) for i, (v, y) in enumerate(zip(vectors, rng.integers(0, 3, count)))]


@pytest.mark.parametrize("bucket_rows,block", [(4096, 50_000), (32, 3)])
def test_against_every_pair(spark, bucket_rows, block):
    rows = cloud(1, 700)
    expected = plain(rows)
    assert len(expected) > 50
    assert mined(spark, rows, bucket_rows=bucket_rows, block=block) == expected


def test_ties_copies_and_repeated_rows(spark):
    same = [1.0, 0.5, 0.0, -0.25]
    rows = [(i, same, i % 2) for i in range(0, 400)] + [(i, [0.5, 0.5, 0.0, 0.0], 1) for i in range(400, 500)]
    rows += rows[:120] + [(50, same, 1), (50, [0.1] * 4, 0)]
    assert mined(spark, rows) == plain(rows)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(2, 120) + [
        (150, None, 1), (200, [1.0] * 6, None), (None, [1.0] * 6, 1), (250, [nan] + [1.0] * 5, 1),
        (300, [inf] * 6, 1), (350, [None] + [1.0] * 5, 1), (400, [0.0] * 6, 1), (450, [-1.0] * 6, 2),
        (500, [1000.0] * 6, 0), (501, [999.0] * 6, 0), (502, [700.0] * 6, 1),
    ]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert mined(spark, [(50, [], 0), (2, [], 0), (3, [], 1)]) == [(50, 2, 1, 3, 0, 0)]
    short = [(50, [1.0], 0), (2, [1.0, 0.5], 0), (3, [0.9], 1)]
    assert mined(spark, short) == [(50, 2, 1, 3, 65536, 256 * 230)]


def test_no_row_within_the_cosine_is_outside_its_bounds():
    rng = np.random.default_rng(3)
    unit = rng.normal(size=(400, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    cosines = unit @ unit.T
    for cosine in (-0.5, 0.0, 0.4, 0.8, 0.99):
        low, high = feasible(np.full(400, cosine), unit)
        for q in range(400):
            near = unit[cosines[q] >= cosine]
            assert (near >= low[q]).all() and (near <= high[q]).all()


def test_lists_prune_rows_and_short_buckets_are_passed_over():
    rng = np.random.default_rng(4)
    cells = rng.integers(-200, 200, (2000, 4)).astype(np.int32)
    cells[:1000, 0] += 900
    made = Bucket(_bucket(0, np.arange(2000), np.zeros(2000, np.int64), cells))
    unit = directions(cells).astype(float)
    low, high = feasible(np.full(3, 0.9), unit[:3])
    inside = made.candidates(np.tile(np.arange(4), (3, 1)), low, high)
    assert 0 < inside.sum() < 3 * 1200
    assert (inside >= (unit[:3] @ unit.T >= 0.9)).all()
    bands = np.full((1, 1), 10**9), np.full((1, 1), HIGHEST)
    state = Search(np.array([-1]), np.zeros(1, np.int64), cells[:1], *bands, best=2, same=True)
    state._block = None  # a bucket whose longest row cannot reach 10^9 is not opened
    state.visit(made)
    assert (state.scores == LOWEST).all()
