from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from quarrystone.llm import topk

SCHEMA = "vec_id long, embedding array<float>, id string, row string, b string, score string"


def brute(rows, asks, k):
    out = []
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    for i, q in usable:
        if asks(i):
            scores = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q)]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, rows, asks, k=5, **sizes):
    frame = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(frame, asks, k, **sizes).collect()))


def test_matches_brute_force_over_several_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)]
    want = brute(rows, lambda i: i % 10 == 0, 5)
    for sizes in ({}, {"block_rows": 37, "group_queries": 5}):
        assert run(spark, rows, F.col("vec_id") % 10 == 0, **sizes) == want


def test_nulls_odd_numbers_and_lengths(spark):
    rows = [(0, [0.5, 0.25]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]),
            (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [0.1, -0.9]), (8, [0.5, 0.25]), (50, [3e12, -2e12])]
    assert run(spark, rows, F.col("vec_id") % 50 == 0) == brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, [], F.col("vec_id") % 50 == 0) == []


def test_repeated_rows_are_candidates_each(spark):
    rows = [(0, [1.0]), (1, [2.0]), (1, [2.0]), (2, [1.0])]
    assert run(spark, rows, F.col("vec_id") == 0, k=3) == [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 2, 65536)]


def test_bounds_hold_and_few_exact_vectors_are_read(spark):
    rng = np.random.default_rng(3)
    for spread in (1, 300, 2**40):
        x, q = rng.integers(-spread, spread + 1, (50, 6)), rng.integers(-spread, spread + 1, (9, 6))
        shifts = np.array([max(0, max(int(v.max()), -int(v.min()) - 1).bit_length() - 7) for v in x])
        cells = (x >> shifts[:, None]).astype(np.int8)
        low, high = topk.bounds(cells, shifts, q)
        exact = q.astype(object) @ x.T.astype(object)
        assert (low <= exact).all() and (exact <= high).all()
        assert spread > 1 or (low == high).all()
    vectors = spark.createDataFrame(
        [(i, [int(v) for v in rng.normal(0, 300, 32)], i % 50 == 0, 32, i) for i in range(2_000)], "id long, x array<long>, asks boolean, dims int, row long"
    )
    read = topk.survivors(vectors, 5, block_rows=500).count()
    assert 5 * 40 <= read < 0.02 * 40 * 2_000
