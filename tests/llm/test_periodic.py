from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarrystone.llm import periodic as p


def brute_runs(words, least=24, times=3):
    """Every lag, every maximal stretch; the smallest period by trying all."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            own = words[s : s + length]
            if length >= max(least, times * q) and not any(own[r:] == own[:-r] for r in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        period = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    best = (None,) * 4
    for s, m, q in runs:
        if best[1] is None or m * best[2] > best[1] * q:
            best = (s, m, q, 1000 * m // q)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    return (doc_id, len(runs), *best, sha(lines), sha(b" ".join(kept)))


def made(rng, alphabet):
    """Random words with repeats of random periods, some of them nested or broken."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        piece = [rng.randrange(alphabet) for _ in range(rng.choice((1, 2, 3, 7, 8, 9, 11, 12, 13, 18, 19, 27, 40, 61)))]
        if rng.random() < 0.3:
            piece = piece * 3 + [alphabet]
        out += piece * rng.choice((1, 2, 3, 4)) + piece[: rng.randrange(len(piece))]
        if rng.random() < 0.3 and out:
            out[rng.randrange(len(out))] = alphabet + 1
    return out


def test_runs_match_brute_force():
    rng, seen = random.Random(3), 0
    for turn in range(700):
        ids = made(rng, rng.choice((1, 2, 3, 50)))
        want = brute_runs(ids)
        assert p.runs(np.array(ids, np.int64)) == want
        seen += len(want)
    assert seen > 300


def test_every_period_is_found():
    rng = random.Random(9)
    for q in [*range(1, 80), 100, 181, 300, 513]:
        block = [rng.randrange(10**6) for _ in range(q)]
        tail = rng.randrange(q)
        periods = max(3, -(-24 // q))
        ids = [-1, -2, *block * periods, *block[:tail], -3, -4, -5]
        assert p.runs(np.array(ids)) == [(2, periods * q + tail, q)]
        short = [*block * 2, *block[:-1]] if q > 8 else block * (23 // q)
        assert p.runs(np.array([-1, *short, -2])) == []


def test_lines_that_come_back_unevenly_are_no_runs():
    rng = random.Random(2)
    line, ids = list(range(20)), []
    for _ in range(300):
        ids += line + [rng.randrange(10**6) for _ in range(rng.randrange(1, 60))]
    assert p.runs(np.array(ids)) == []


def test_query_matches_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{x}" for x in made(rng, 20))) for i in range(200)]
    docs += [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(200)))) for i in range(200, 400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = sorted(map(tuple, p.digests(frame).collect()))
    assert found == sorted(brute(*d) for d in docs)
    assert sum(r[1] > 0 for r in found) > 60


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect() if r.doc_id != 7]
    found = sorted(map(tuple, p.digests(odd.where("doc_id is null or doc_id != 7")).collect()), key=str)
    assert found == sorted((brute(*r) for r in rows), key=str)
    (long,) = p.periodic_runs(odd.where("doc_id = 7")).collect()
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert p.digests(odd.where(F.lit(False))).collect() == []
