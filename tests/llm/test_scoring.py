from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import recurrent, scoring


def brute_base(rows):
    """(n_tokens, n_known, train_tokens, base score) of each row."""
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    counts = Counter()
    for i, found in tokens:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(found)
    total, distinct = sum(counts.values()), len(counts)
    prob = lambda w: math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1)))
    return [(i, len(f), sum(counts[w] > 0 for w in f), total, sum(map(prob, f))) for i, f in tokens]


def texts(n=150):
    """Two kinds of text with words of their own: knowing the kind helps with the next word."""
    rng = random.Random(8)
    kinds = [[f"{p}{i}" for i in range(40)] for p in "ab"]
    return [(i, " ".join(rng.choice(kinds[i % 2]) for _ in range(rng.randrange(5, 120)))) for i in range(n)]


@pytest.mark.parametrize("known", [65_536, 30, 1])
def test_base_scores_match_plain_counting(documents, monkeypatch, known):
    monkeypatch.setattr(scoring.vocabulary, "__defaults__", (8, known))
    rows = texts(60) + [(500, "never seen words a1 A1"), (501, None), (501, None)]
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scoring.score(documents(rows)).collect())
    want = sorted((str(r[0]), *r[1:]) for r in brute_base(rows))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert [g[4] for g in got] == pytest.approx([w[4] for w in want])


def test_the_network_beats_counts_on_held_out_documents(documents):
    rows = [r for r in scoring.score(documents(texts(400))).collect() if r.held_out]
    assert len(rows) > 20
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.05 * sum(r.n_tokens for r in rows)


def small_net():
    rng = np.random.default_rng(0)
    weights = recurrent.initial(rng.integers(1, 100, 130).astype(float), rng.integers(1, 100, 5).astype(float), hidden=6)
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    return weights, [rng.integers(0, 130, 7), np.array([192, 193, 3, 196, 5]), rng.integers(0, 130, 12)]


def test_probabilities_of_all_words_sum_to_one():
    weights, _ = small_net()
    words = [*range(130), *range(192, 197)]
    total = sum(10 ** recurrent.log10_likelihoods(weights, [np.array([7, w])])[0] for w in words)
    assert total == pytest.approx(10 ** recurrent.log10_likelihoods(weights, [np.array([7])])[0], rel=1e-5)


def test_documents_are_scored_alike_alone_and_in_lanes():
    weights, docs = small_net()
    docs = docs * 7 + [np.tile(docs[0], 30)]
    alone = [recurrent.log10_likelihoods(weights, [d])[0] for d in docs]
    assert recurrent.log10_likelihoods(weights, docs, lanes=4) == pytest.approx(alone, rel=1e-5)


def test_gradients():
    weights, docs = small_net()
    rng = np.random.default_rng(1)
    inputs, targets, document, fresh = next(recurrent.Lanes(docs, len(weights["E"]) - 1, 2).windows(40))
    start = np.zeros((6, inputs.shape[1]))
    loss = lambda: -recurrent.gradients(weights, inputs, targets, document >= 0, fresh, start)[0]
    _, grads, _ = recurrent.gradients(weights, inputs, targets, document >= 0, fresh, start)
    dense = np.zeros_like(weights["E"])
    dense[grads["E ids"]] = grads["E"]
    for name, grad in {**{k: grads[k] for k in weights}, "E": dense}.items():
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in grad.shape)
            own = weights[name][at]
            weights[name][at] = own + 1e-4
            high = loss()
            weights[name][at] = own - 1e-4
            low = loss()
            weights[name][at] = own
            assert (high - low) / 2e-4 == pytest.approx(grad[at], abs=2e-3)


def test_scores_do_not_depend_on_tasks(documents, monkeypatch):
    monkeypatch.setattr(scoring, "SHARD_TOKENS", 2_000)
    monkeypatch.setattr(scoring, "FAN_IN", 3)
    frame = documents(texts(200))
    scores = [sorted((r.doc_id, r.score) for r in scoring.score(frame.repartition(n, "text")).collect()) for n in (1, 4, 32)]
    for other in scores[1:]:
        assert [i for i, _ in other] == [i for i, _ in scores[0]]
        assert [x for _, x in other] == pytest.approx([x for _, x in scores[0]], rel=1e-6)


def test_frequent_words_that_share_one_level(documents):
    counts = documents([(1, " ".join(f"w{i}" for i in range(300)))])
    v = scoring.vocabulary(scoring.count_words(counts), 8, 100)
    assert 8 < len(v.known) <= 101 and v.head == 8


def test_odd_rows_and_empty_table(odd):
    want = brute_base([(r.doc_id, r.text) for r in odd.collect()])
    got = scoring.score(odd).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known) for r in got) == sorted((str(i), n, k) for i, n, k, _, _ in want)
    assert all(math.isfinite(r.score) for r in got)
    assert scoring.score(odd.where(F.lit(False))).count() == 0
