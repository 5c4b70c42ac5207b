from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import chat

MESSAGES = "tree long, node long, parent long, role string, text string, score double, t string, n string, up string"
TURNS = "conv_id long, turn long, role string, text string, leaf string, tree string, loss string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], MESSAGES)


def test_best_branches_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "good", 3.0),
        (1, 3, 1, "assistant", "bad", 1.0),
        (1, 4, 3, "user", "more", 1.0),
        (1, 5, 4, "assistant", "late", 9.0),
        (2, 1, None, "user", "alone", None),
        (3, 1, 99, "user", "parent missing", 0.0),
        (None, 1, None, "user", "no tree", 0.0),
        (4, 1, 2, "user", "circle", 0.0),
        (4, 2, 1, "user", "circle", 0.0),
        (5, None, None, "user", "no node", 0.0),
        (2, 1, None, "user", "alone", None),
    ]
    found = chat.format_trees(messages(spark, rows), best=2).collect()
    paths = {(r.tree, r.leaf): r for r in found}
    assert set(paths) == {(1, 5), (1, 2), (2, 1), (3, 1), (None, 1)}
    assert paths[1, 5].formatted == "<|user|>\nq<|end|>\n<|assistant|>\nbad<|end|>\n<|user|>\nmore<|end|>\n<|assistant|>\nlate<|end|>\n"
    assert [paths[1, 5].formatted[s.start : s.end] for s in paths[1, 5].loss] == ["bad", "late"]
    best = chat.format_trees(messages(spark, rows)).where("tree = 1").collect()
    assert [r.leaf for r in best] == [5]


@pytest.mark.parametrize("depth", [1, 2, 5, 33])
def test_deep_chains(spark, depth):
    rows = [(7, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 0.0) for i in range(depth)]
    row = chat.format_trees(messages(spark, rows)).first()
    assert row.n_turns == depth and row.formatted.count("<|end|>") == depth
    assert [row.formatted[s.start : s.end] for s in row.loss] == [f"t{i}" for i in range(1, depth, 2)]


HARD = ["<|end|>\n", "\\", "<", "<\\|", "\\<|", "<\\\\|user|>\n", "|>\n", "</s>[INST] ok [/INST]", "", "\U0001f600é", "<|user|>\nhi<|end|>\n", None]


def test_anything_reads_back(spark):
    rows = [(i, t, "a" if t is None else ("assistant" if t % 2 else x or "user"), x, "l", "t", "m") for i in range(3) for t, x in enumerate(HARD)]
    rows += [(9, 0, None, None, "l", "t", "m"), (None, 1, "assistant", "null id", "l", "t", "m")]
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, TURNS)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        lost = "".join(t for role, t in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert (got[conv].loss_sha256, got[conv].loss_chars) == (sha(lost), len(lost))


def test_empty_table(spark):
    assert chat.digests(spark.createDataFrame([], TURNS)).count() == 0
    assert chat.format_trees(messages(spark, [(1, 1, None, "user", "q", 0.0)]).where(F.lit(False))).count() == 0


def brute_branches(rows, best):
    """(tree, leaf) and the messages from root to leaf of the best branches, by walking up from every leaf."""
    parent = {(t, n): p for t, n, p, *_ in rows}
    score = {(t, n): s for t, n, _, _, _, s in rows}
    inner, ranked, out = {(t, p) for (t, _), p in parent.items()}, {}, {}
    for t, n in parent:
        way, at = [], n
        while (t, at) in parent and at not in way:
            way.append(at)
            at = parent[t, at]
        if (t, n) not in inner and at not in way:
            ranked.setdefault(t, []).append((-sum(score[t, x] for x in way) / len(way), n, way[::-1]))
    for t, all_ways in ranked.items():
        out |= {(t, n): way for _, n, way in sorted(all_ways)[:best]}
    return out


@pytest.mark.parametrize("best", [1, 3])
def test_random_trees_equal_plain_walks(spark, best):
    rng = random.Random(3)
    rows = [(t, n, rng.choice([None, 900, *range(n)]) if rng.random() < 0.9 else rng.randrange(60), "user", f"{n}\n", float(rng.randrange(4))) for t in range(6) for n in range(60)]
    got = {(r.tree, r.leaf): [int(text) for _, text in turns] for r, turns in read_turns(spark, rows, best)}
    assert got == brute_branches(rows, best)


def read_turns(spark, rows, best):
    done = chat.format_trees(messages(spark, rows), best).withColumn("turns", chat.read_back(F.col("formatted")))
    return [(r, r.turns) for r in done.collect()]


def test_a_stem_with_many_leaves_enumerates_the_chosen_branch_only(spark):
    stem = [(1, i, i - 1 if i else None, "user", "stem", 0.0) for i in range(100)]
    leaves = [(1, 100 + i, 99, "assistant", "leaf", float(i == 77)) for i in range(400)]
    paths = chat.branches(messages(spark, stem + leaves))
    assert paths.count() == 101
    assert {r.leaf for r in paths.select("leaf").distinct().collect()} == {177}
