from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators.dedup import first_per_key


def _null_last(row, columns):
    return [(row[c] is None, row[c] or "") for c in columns]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("keys", [["k"], ["k", "a"]])
def test_agrees_with_brute_force(spark, seed, keys):
    rng = random.Random(seed)
    columns = ["k", "a", "b", "c"]
    rows = [tuple(rng.choice(["x", "y", "z", "", None]) for _ in columns) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, a string, b string, c string").repartition(7)
    order = ["b", *[c for c in columns if c not in keys and c != "b"]]
    best = {}
    for values in rows:
        row = dict(zip(columns, values))
        key = tuple(row[k] for k in keys)
        if key not in best or _null_last(row, order) < _null_last(best[key], order):
            best[key] = row
    found = {tuple(r[k] for k in keys): r.asDict() for r in first_per_key(df, keys, ["b"]).collect()}
    assert found == best


def test_choice_does_not_depend_on_arrival(spark):
    df = spark.range(0, 5000).selectExpr("id % 50 AS k", "'same' AS o", "uuid() AS v").persist()
    df.count()
    first = {r.k: r.v for r in first_per_key(df, ["k"], ["o"]).collect()}
    shuffled = df.repartition(13).orderBy(F.rand(5))
    assert {r.k: r.v for r in first_per_key(shuffled, ["k"], ["o"]).collect()} == first
    df.unpersist()
