from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from quarrystone.llm import bpe
from quarrystone.llm.common import rank_file

VOCABULARY = bpe.default_vocabulary()


def plain_ids(text: str) -> list[int]:
    """Merges the pair of lowest rank until none is left, pre-token by pre-token."""
    import public_tokenizers
    import regex

    ranks, out = rank_file(VOCABULARY), []
    for match in regex.finditer(public_tokenizers.PATTERN, text):
        parts = [bytes([b]) for b in match[0].encode()]
        while len(parts) > 1:
            pairs = [(ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)]
            rank, i = min(pairs)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [ranks[p] for p in parts]
    return out


TEXTS = [
    "Hello world, it's   a test.\n\n  Two  lines 12345",
    "don't we'll I'd they've\t\ttabs été 中文字 \U0001f600\U0001f600",
    "'s 're   ",
    "a" * 90 + " " + "b" * 90,
    " " * 200 + "x",
    "\n" * 70 + "y" + "\n" * 70,
    "",
]


@pytest.mark.parametrize("chunk,overlap", [(16_384, 512), (24, 8), (40, 3)])
def test_matches_plain_merging_at_any_chunk_size(documents, chunk, overlap):
    got = bpe.encode(documents(TEXTS), VOCABULARY, chunk=chunk, overlap=overlap).collect()
    assert {r.doc_id: r.ids for r in got} == {i: plain_ids(t) for i, t in enumerate(TEXTS)}
    assert all(r.n_tokens == len(r.ids) for r in got)


def test_round_trip_and_odd_rows(odd):
    given = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd.collect()))
    rows = bpe.decode(bpe.encode(odd, VOCABULARY, chunk=4_000, overlap=100), VOCABULARY).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.bytes).decode()) for r in rows) == given


def test_digests_of_short_and_long_texts(documents, odd):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted((i, len(plain_ids(t)), sha(",".join(map(str, plain_ids(t))).encode()), sha(t.encode())) for i, t in enumerate(TEXTS))
    for chunk, overlap in ((16_384, 512), (40, 8)):
        assert sorted(map(tuple, bpe.digests(documents(TEXTS), VOCABULARY, chunk, overlap).collect())) == want
    rows = bpe.digests(odd, VOCABULARY, 4_000, 100).collect()
    assert sorted(r.decoded_sha256 for r in rows) == sorted(sha((r.text or "").encode()) for r in odd.collect())


def test_digests(documents):
    text = "some text with words"
    row = bpe.digests(documents([text]), VOCABULARY).first()
    ids = ",".join(map(str, plain_ids(text)))
    assert row.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_repeated_long_rows_and_empty_table(documents):
    long = "some words " * 400
    rows = bpe.encode(documents([(1, long), (1, long), (2, long)]), VOCABULARY, chunk=1_000, overlap=50).collect()
    assert [(r.doc_id, r.ids) for r in sorted(rows, key=lambda r: r.doc_id)] == [(i, plain_ids(long)) for i in (1, 1, 2)]
    assert bpe.digests(documents([(1, long)]).where(F.lit(False)), VOCABULARY).count() == 0


def test_overlap_must_fit():
    with pytest.raises(ValueError):
        bpe.encode(None, VOCABULARY, chunk=10, overlap=10)
