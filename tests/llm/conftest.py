from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """A documents table from texts, or from (doc_id, text[, lang[, source]]) rows."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = (i, row) if not isinstance(row, tuple) else row
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return build


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\f\r "),
    (4, "one"),
    (5, "one"),
    (5, "one"),
    (None, "no id at all here"),
    (6, "a b   ünïcödé \U0001f600 end"),
    (7, "word " * 30_000),
    (8, "x" * 100_000),
]


@pytest.fixture()
def odd(documents):
    """Nulls, empty and very long texts, ties, repeated rows, and further columns with names operators use."""
    from pyspark.sql import functions as F

    clash = ["id", "key", "k", "size", "bucket", "n", "ids", "words", "h", "toxicity", "copy", "c", "row", "rank"]
    return documents(ODD).withColumns({name: F.lit("clash") for name in clash})
