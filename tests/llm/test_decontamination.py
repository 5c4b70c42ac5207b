from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from quarrystone.llm import decontamination as d

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, span=10):
    split = lambda text: WORD.findall((text or "").translate(LOWER))
    windows = {}
    for item, text in items:
        own = split(text)
        size = min(span, len(own))
        for s in range(len(own) - size + 1) if own else ():
            windows.setdefault(tuple(own[s : s + size]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for i, text in docs:
        own, hit, met = split(text), set(), set()
        for size in sizes:
            for s in range(len(own) - size + 1):
                found = windows.get(tuple(own[s : s + size]))
                if found:
                    hit |= set(range(s, s + size))
                    met |= {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((i, len(own), len(hit), len(met), digest, bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    texts = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("k1", "size", "words", "mark")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("doc_id", "size", "mark", "words")})
    return sorted(map(tuple, d.digests(texts, asked).collect()), key=str)


def test_matches_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdef") + rng.choice("xyz")
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 2, 3, 5, 9, 10, 11, 30))))) for i in range(3, 25)]
    items += [(100, items[-1][1]), (101, None), (102, " .,- "), (None, " ".join(word() for _ in range(12))), (3, items[4][1])]
    docs = []
    for i in range(150):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 60)))]
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(own) + 1)
            parts += [" ".join(own[at : at + rng.randrange(5, 15)]).upper(), word()]
        docs.append((i, rng.choice((" ", "; ", "\n")).join(parts)))
    assert run(spark, docs, items) == brute(docs, items)


def test_every_window_is_found_at_any_place(spark):
    rng = random.Random(1)
    item = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(31):
        fill = [f"f{rng.randrange(10**6)}" for _ in range(50)]
        docs.append((i, " ".join(fill[: i + 3] + item[i : i + 10] + fill[i + 3 :])))
    docs.append((99, " ".join(item[:9] + ["x"] + item[10:19])))
    rows = run(spark, docs, [(1, " ".join(item))])
    assert [r[2] for r in sorted(rows)] == [10] * 31 + [0]


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "word"), (2, "no id at all here"), (3, "ünïcödé\U0001f600 end"), (4, "WORD word word word word word word word word word word")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, d.digests(odd, asked).collect()), key=str) == brute(rows, items)
    assert d.digests(odd.where(F.lit(False)), asked).collect() == []
    nothing = d.digests(odd, asked.where(F.lit(False))).collect()
    assert len(nothing) == len(rows) and not any(r.contaminated or r.n_items for r in nothing)


def test_a_passage_in_many_documents_and_items(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"own{i} {passage} more{i}" if i % 3 else passage) for i in range(300)]
    items = [(i, f"{passage} item{i}") for i in range(60)]
    rows = run(spark, docs, items)
    assert rows == brute(docs, items) and {r[3] for r in rows} == {60}
