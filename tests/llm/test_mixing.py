from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import mixing

SIZED = "doc_id long, source string, size long, ix string, bucket string, start string, h string, rank string, words string"


def sized(spark, rows):
    return spark.createDataFrame([(*r, *"xxxxxx") for r in rows], SIZED)


def brute_targets(rows):
    sizes: dict = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + (size or 0)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, held = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return held | share, sizes
        held |= {s: 2.0 * sizes[s] for s in over}


def check(spark, rows, block):
    found = mixing.mix(sized(spark, rows), block=block)
    documents = found.documents.collect()
    targets, sizes = brute_targets(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in documents) == sorted((i is None, i or 0, s or 0) for i, _, s in rows)
    taken: dict = {}
    for r in documents:
        assert r.target == pytest.approx(targets[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 1e-9) for s, t in targets.items()}
    slots = found.slots.collect()
    assert len({r.slot for r in slots}) == len(slots)
    return documents, slots


def test_targets_are_met_exactly_and_no_document_doubles(spark):
    rows = [(i, f"s{i % 7}" if i % 3 else "big", i * 37 % 91) for i in range(400)]
    documents, slots = check(spark, rows, 25)
    assert sorted(map(tuple, mixing.mix(sized(spark, rows).repartition(5), block=25).documents.collect())) == sorted(map(tuple, documents))
    # In any stretch of the schedule every source comes near its share of the slots.
    share = {ix: sum(r.ix == ix for r in slots) / len(slots) for ix in {r.ix for r in slots}}
    ordered = [r.ix for r in sorted(slots, key=lambda r: r.slot)]
    for at in range(0, len(ordered) - 100, 50):
        for ix, part in share.items():
            assert abs(ordered[at : at + 100].count(ix) - 100 * part) <= 8


def test_odd_rows(spark):
    rows = [(1, None, 10), (1, None, 10), (None, "a", 5), (2, "a", None), (3, "a", 0), (4, "b", 100_000), (5, "", 7), (6, "é", 0)]
    check(spark, rows, 1_000)


def test_one_source_and_empty_table(spark):
    check(spark, [(1, "a", 3), (2, "a", 3)], 4)
    assert mixing.mix(sized(spark, [(1, "a", 1)]).where(F.lit(False))).documents.count() == 0


def test_sizes_of_odd_texts(odd):
    want = sorted(len((r.text or "").encode().split()) for r in odd.collect())
    assert sorted(r.size for r in mixing.mixed_sizes(odd).collect()) == want
