from __future__ import annotations

import hashlib
import uuid
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quarrystone.llm import common, secrets, toxicity
from tests.llm.test_dedup import brute

DATA = "/root/testdata/sf0.001"


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity.classify(docs, labels).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, p in scores.items() if not p)

    single = stages["near copies"](spark, docs, DATA)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(str(r.doc_id) for r in single.collect()) == sorted({least for _, _, least in brute(rows, 5, 80)})

    masked = stages["secrets"](spark, docs, DATA)
    found = {r.doc_id: r.text for r in masked.collect()}
    assert set(found) == {i for i, _ in rows}
    for i, text in rows:
        spans = secrets.base_spans(text)
        assert all(text[s:e] not in found[i] for s, _, e in spans)
        assert spans or "[SECRET]" in found[i] or found[i] == text

    mixed = Counter(r.doc_id for r in stages["mixing"](spark, docs, DATA).collect())
    texts = dict(rows)
    words = sum(len(texts[i].encode().split()) * n for i, n in mixed.items())
    total = sum(len(t.encode().split()) for t in texts.values())
    assert max(mixed.values()) <= 2 and 1.4 * total < words < 1.7 * total

    coded = stages["byte BPE"](spark, docs, DATA).collect()
    assert {r.doc_id: r.decoded_sha256 for r in coded} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}
    for frame in (kept, single, masked):
        assert frame.columns == docs.columns and frame.dtypes == docs.dtypes


def test_whole_run_and_odd_rows(spark, odd):
    assert pipeline.run(spark, DATA).count() > 0
    for docs in (odd, odd.where(F.lit(False))):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, DATA)
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= {None, *range(1, 9)}


def test_rows_of_one_id_or_none_are_told_apart(spark, documents):
    text = lambda w: " ".join(f"{w}{i}" for i in range(40))
    stages = dict(pipeline.STAGES)
    rows = [(1, text("a")), (2, text("b")), (2, text("a")), (2, text("b"), "en"), (None, text("c")), (None, text("c")), (None, text("a")), (3, None)]
    kept = [tuple(r)[:2] for r in stages["near copies"](spark, documents(rows), DATA).collect()]
    assert sorted(kept, key=str) == sorted([(1, text("a")), (2, text("b")), (None, text("c")), (3, None)], key=str)

    sources = [(None, text(f"x{i}"), None, "one") for i in range(60)] + [(7, text("same"), None, "two")] * 60 + [(i, text(f"z{i}"), None, "three") for i in range(60)]
    mixed = stages["mixing"](spark, documents(sources), DATA).collect()
    words = Counter(r.source for r in mixed)
    total = 60 * 3 * 40
    share = {"one": 5 / 8, "two": 1 / 8, "three": 2 / 8}
    # A source stops at twice its size; what it leaves goes to the others by weight. A document counts whole.
    targets = {s: min(2 * 60 * 40, x * 1.5 * total) for s, x in share.items()}
    assert abs(words["one"] * 40 - targets["one"]) <= 40
    assert max(Counter(r.text for r in mixed if r.source == "one").values()) <= 2
    assert sum(words.values()) * 40 >= 1.49 * total


def test_scratch_tables_of_earlier_stages_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")
    rows = pipeline.run(spark, DATA)
    assert rows.count() > 0
    names = [p.name for p in tmp_path.iterdir()]
    assert sum(n.startswith("stage-") for n in names) == 1 and not any(n.startswith(("dedup", "mix", "toxicity")) for n in names)
