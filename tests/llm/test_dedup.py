from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.llm import dedup


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    """Least id of each row's component, by comparing all pairs."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    least: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted((str(rows[i][0]), len(sets[i]), str(least.get(root(i)) if sets[i] else rows[i][0])) for i in range(len(rows)))


def found(documents, rows, settings):
    got = dedup.near_duplicates(documents(rows), settings).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(documents, width, percent):
    rng = random.Random(width)
    texts = [t for k in range(6) for t in family(rng, 25, 60 + 20 * k, 7)]
    texts += texts[:20] + ["Same Words Here", "same words here", "same words", "same words", "x", "", None]
    rng.shuffle(texts)
    rows = [(1_000 - i, t) for i, t in enumerate(texts)]
    assert found(documents, rows, dedup.Settings(width, percent)) == brute(rows, width, percent)


def test_chains_link_through_neighbours(documents):
    words = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 80])) for i in range(12)]
    assert found(documents, rows, dedup.Settings()) == brute(rows, 3, 85)


def test_a_shared_passage_links_nobody(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"d{i}x{j}" for j in range(30))) for i in range(150)]
    assert found(documents, rows, dedup.Settings()) == brute(rows, 3, 85)


def test_a_text_without_an_id_links_two_others(documents):
    words = [f"w{i}" for i in range(102)]
    ends = [" ".join(words[:92]), " ".join(words[10:])]
    middle = " ".join(words[4:98])
    for bridge in (3, None):
        rows = [(1, ends[0]), (2, ends[1]), (bridge, middle), (bridge, middle)]
        want = brute(rows, 3, 85)
        assert found(documents, rows, dedup.Settings()) == want and {c for _, _, c in want} == {"1"}
    assert {c for _, _, c in brute([(1, ends[0]), (2, ends[1])], 3, 85)} == {"1", "2"}
    rows = [(None, ends[0]), (None, ends[1]), (None, middle), (None, "other words here")]
    groups = dedup.near_duplicates(documents(rows)).collect()
    assert all(r.kept and r.component_id is None for r in groups) and len({r.component for r in groups}) == 2


def test_tiles_of_a_bucket_lose_no_pair(documents, monkeypatch):
    monkeypatch.setattr(dedup, "TILE", 3)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(120):
        own = [f"d{i // 2}x{j}" for j in range(14)]
        if i % 2:
            own[rng.randrange(14)] = "z"
        rows.append((i, " ".join(passage + own)))
    want = brute(rows, 3, 85)
    assert found(documents, rows, dedup.Settings()) == want and len({c for _, _, c in want}) > 20


def test_odd_rows_and_empty_table(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = dedup.near_duplicates(odd).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        (d, n, d if d == "None" else c) for d, n, c in brute(rows, 3, 85)
    )
    assert dedup.near_duplicates(odd.where(F.lit(False))).count() == 0


def test_sequential_comparison_keeps_pairs_at_the_threshold():
    settings = dedup.Settings()
    rng, lost, trials = np.random.default_rng(2), 0, 4_000
    for _ in range(trials):
        equal = rng.random(settings.hashes) < settings.percent / 100
        lost += any(equal[:n].sum() < m for n, m in dedup.least_matches(settings))
    assert lost <= trials * 1e-3
    assert (1 - (settings.percent / 100) ** settings.rows) ** settings.bands <= settings.band_miss
