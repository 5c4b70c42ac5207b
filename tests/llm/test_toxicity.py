from __future__ import annotations

import random
import zlib

from pyspark.sql import functions as F

from quarrystone.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "stupid", "moron", "worthless", "disgusting", "pathetic"]


def corpus(n=400):
    rng = random.Random(4)
    plain = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrs')}{rng.choice('aeiou')}{i % 50}" for i in range(200)]
    rows, marks = [], []
    for i in range(n):
        words, toxic = [rng.choice(plain) for _ in range(rng.randrange(20, 60))], int(i % 4 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    return rows, marks


def test_held_out_documents(spark, documents):
    rows, marks = corpus()
    got = toxicity.classify(documents(rows), spark.createDataFrame(marks, LABELS)).collect()
    truth = {i: t for i, _, t in marks}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 50


def test_a_toxic_word_is_shorter_with_the_toxic_dictionary():
    ordinary = toxicity.HEAD * 2 + "some plain words of every day " + toxicity.HEAD
    toxic = toxicity.HEAD * 2 + "some plain words of every day worthless disgusting " + toxicity.HEAD
    windows = toxicity.Windows(ordinary.encode(), toxic.encode())
    assert windows("disgusting") >= 3 and windows("unrelated") == 0
    d = windows("disgusting")
    assert windows.savings("disgusting " + "plain " * 10 + "y" * 1_000) == [max(0, d - t) for t in range(7)]


def test_odd_rows_and_missing_labels(spark, odd, documents):
    rows, marks = corpus(120)
    docs = documents(rows)
    model = toxicity.train(docs, spark.createDataFrame([*marks, (None, 1, 1), (5, 1, None), (3, 0, 0), (3, 0, 1)], LABELS))
    scored = toxicity.score(odd.drop("toxicity"), model)
    assert scored.columns == [*odd.drop("toxicity").columns, "toxicity"]
    assert all(0 <= r.toxicity <= 1 for r in scored.collect())
    none = toxicity.classify(odd, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == odd.count() and all(r.score == 0 and r.predicted == 0 for r in none)
    assert toxicity.classify(docs.where(F.lit(False)), spark.createDataFrame(marks, LABELS)).count() == 0


def test_scores_match_plain_compression_of_every_window(spark, documents):
    import numpy as np
    import zstandard as z

    rows, marks = corpus(200)
    rows += [(1_000, "idiot " * 30 + "x" * 50 + "moron" + "y" * 90), (1_001, ""), (1_002, "ba" * 300)]
    model = toxicity.train(documents(rows), spark.createDataFrame(marks, LABELS))

    def compressed(content, window):
        words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        bits = {x: toxicity.TABLE_BITS for x in ("hash_log", "chain_log", "window_log")}
        plain = z.ZstdCompressionParameters.from_level(toxicity.LEVEL, **bits, write_content_size=False, write_checksum=False, write_dict_id=False)
        words.precompute_compress(compression_params=plain)
        data = (toxicity.HEAD + window + toxicity.TAIL).encode()
        return len(z.ZstdCompressor(dict_data=words, compression_params=plain).compress(data))

    scored = {r.doc_id: r.toxicity for r in toxicity.score(documents(rows), model).collect()}
    for i, text in rows[:40] + rows[-3:]:
        windows = set()
        for word in text.split():
            windows |= {word} if len(word) <= 64 else {word[a : a + 64] for a in range(0, len(word), 32)}
        gains = [compressed(model.ordinary, w) - compressed(model.toxic, w) for w in windows]
        least = model.least
        saved = [sum(max(0, g - t) for g in gains) for t in (least, least + 2)]
        below = sum(0 < g <= max(least, 1) for g in gains)
        x = np.array([1, *np.log1p([*saved, below])]) @ np.array(model.weights)
        assert abs(scored[i] - 1 / (1 + np.exp(-x))) < 1e-9


def test_parts_of_long_words_teach(documents):
    text = "a" * 40 + "b" * 40 + " short"
    assert toxicity.pieces(text) == {"a" * 40 + "b" * 24, "a" * 8 + "b" * 40, "b" * 16, "short"}


def test_chance_matches_in_another_language_are_no_toxic_wording(spark, documents):
    """Texts whose ordinary words share parts with toxic ones stay clean; toxic ones are found in either language."""
    rng = random.Random(7)
    ends = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    rows, marks, kinds = [], [], []
    for i in range(1_200):
        toxic, other = int(i % 4 == 0), i % 2 == 1 or i % 8 == 0
        stems = ["unacht", "einacht"] if other else ["plain", "green", "table"]
        words = [rng.choice(stems) + rng.choice(ends) + rng.choice(ends) for _ in range(60)]
        bad = ["achtlich" + rng.choice(ends) for _ in range(4)] if other else rng.sample(BAD, 3)
        for w in bad * toxic:
            words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
        kinds.append(other)
    got = [r for r in toxicity.classify(documents(rows), spark.createDataFrame(marks, LABELS)).collect() if r.held_out]
    for other in (False, True):
        held = [r for r in got if kinds[r.doc_id] == other]
        found = [r.predicted for r in held if marks[r.doc_id][2]]
        flagged = [r.predicted for r in held if not marks[r.doc_id][2]]
        assert sum(found) >= 0.9 * len(found) > 20 and sum(flagged) <= 0.05 * len(flagged)
