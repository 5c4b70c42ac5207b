from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from quarrystone.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, x string, code string, error string, n string"


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    whole = [v + [0] * (parts * width - len(v)) for _, v, _ in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda x, book: min(range(len(book)), key=lambda e: (distance(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            index = [nearest(c[p], books[p]) for c in cut]
            for e in set(index):
                own = [c[p] for c, i in zip(cut, index) if i == e]
                books[p] = [*books[p][:e], [sum(x) // len(own) for x in zip(*own)], *books[p][e + 1 :]]
    out, per_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        index = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(distance(c[p], books[p][e]) for p, e in enumerate(index))
        per_label[label] = per_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e in index), error, label))
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((i, c, e, per_label[label], sha) for i, c, e, label in out), key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    return sorted(map(tuple, codes.digests(frame).collect()), key=str)


def test_transform_is_the_walsh_hadamard_matrix_in_sequency_order():
    for m in (1, 2, 8, 32):
        h = codes.transformed(np.eye(m, dtype=np.int64))[codes.sequency_order(m)]
        assert np.array_equal(h @ h.T, m * np.eye(m))
        assert [(r[1:] != r[:-1]).sum() for r in h] == list(range(m))


def test_nearest_matches_all_distances():
    rng = np.random.default_rng(2)
    for width in (1, 3, 8, 11):
        for spread in (2, 3000, 2**40, 2**62):
            rows, book = rng.integers(-spread, spread, (200, width)), rng.integers(-spread, spread, (9, width))
            book[5] = book[2]
            wide = (rows.astype(object)[:, None] - book.astype(object)[None]) ** 2
            index, least = codes.nearest(rows, book)
            assert index.tolist() == wide.sum(axis=2).argmin(axis=1).tolist()
            assert [int(x) for x in least] == wide.sum(axis=2).min(axis=1).tolist()


def test_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(0, 1, (5, 64))
    rows = [(i, (centers[i % 5] + rng.normal(0, 0.3, 64)).astype(np.float32).tolist(), i % 3 or None) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(20)]
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [0.5, -0.25], 1), (1, None, 1), (2, [None, 1.0], None), (3, [nan, 1.0], 2), (4, [inf, 0.0], 2), (6, [1.0], None),
            (7, [], None), (None, [1.0, 1.0, -0.00001], 2), (7, [0.1] * 19, 1), (7, [0.1] * 19, 1), (9, [3e5, -2e5], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert run(spark, []) == [] == run(spark, rows[1:2])


def test_entries_without_parts_stay(spark):
    rows = [(i, [float(i // 20)] * 16, 0) for i in range(40)]
    assert run(spark, rows) == brute(rows)


def test_numbers_beyond_a_long_stop_there(spark):
    frame = spark.createDataFrame([(0, [0.0] * 8), (1, [1e30] * 8)], "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    assert {r.vec_id for r in codes.digests(frame).collect()} == {0, 1}
