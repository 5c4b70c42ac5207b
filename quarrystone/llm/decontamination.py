"""Benchmark decontamination by winnowing.

A window of ``span`` words is marked by the least hash among its runs of k words.
A text's fingerprint is the set of these marks, so a window that two texts share
always puts one mark into both fingerprints: no shared span of that length is
missed. Fingerprints of documents and benchmark items are joined; where they
meet, the windows under the common marks are laid out word by word and compared
as they are. Benchmark items shorter than a window are one window of their own
length, and documents get marks for each length that occurs.

Documents with one text share all results, so copies are worked on once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm.common import Query, mixed, schema, slices, sliding, stored, table, whole_text

SPAN = 10

# Bytes of no word by the rule [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (letters are in lower case by then).
_APART = bytes(32 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256))
_KEY = ["k1", "k2"]


def words(text: str) -> list[bytes]:
    """Words of letters, digits and everything beyond ASCII, with A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_APART).split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def marks(each: np.ndarray, span: int) -> np.ndarray:
    """The mark of every window of ``span`` words: the least hash of its runs of half as many words."""
    size = (span + 1) // 2
    if len(each) < span:
        return np.zeros(0, np.uint64)
    runs = np.full(len(each) - size + 1, span, np.uint64)
    for i in range(size):
        runs = mixed(runs + each[i : i + len(runs)])
    return sliding(np.minimum, runs, span - size + 1)


def _item_windows(span: int):
    """(item_id, text) to one row per window: item_id, its number of words, mark and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 18):
            row, sizes, found, held = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                own = words(text.as_py())
                if not own:
                    continue
                size = min(span, len(own))
                mark = marks(word_hashes(own), size).view(np.int64)
                row += [i] * len(mark)
                sizes += [size] * len(mark)
                found += mark.tolist()
                held += [b" ".join(own[s : s + size]) for s in range(len(mark))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(row, pa.int32())), pa.array(sizes, pa.int32()), pa.array(found, pa.int64()), pa.array(held, pa.binary())],
                names=["item_id", "size", "mark", "words"],
            )

    return run


def _fingerprints(spans: list[int]):
    """(doc_id, k1, k2, text) to the number of words and the fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, prints = [], []
            for text in batch.column("text"):
                found = words(text.as_py())
                counts.append(len(found))
                each = word_hashes(found) if spans else np.zeros(0, np.uint64)
                sets = [np.unique(marks(each, s)) for s in spans]
                prints.append(np.concatenate(sets or [each]).view(np.int64))
            ends = np.cumsum([0, *map(len, prints)]).astype(np.int32)
            values = np.concatenate(prints) if prints else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", *_KEY)),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                ],
                names=["doc_id", *_KEY, "n_words", "prints"],
            )

    return run


def _candidates(spans: list[int]):
    """(k1, k2, text, prints in common) to the windows under these marks: place, size and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 18):
            for i in range(batch.num_rows):
                found = words(batch.column("text")[i].as_py())
                common = np.array(batch.column("prints")[i].values).view(np.uint64)
                each = word_hashes(found)
                for size in spans:
                    starts = np.flatnonzero(np.isin(marks(each, size), common))
                    row = pa.array(np.full(len(starts), i, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(row) for c in _KEY),
                            pa.array(starts, pa.int32()),
                            pa.array(np.full(len(starts), size, np.int32)),
                            pa.array([b" ".join(found[s : s + size]) for s in starts.tolist()], pa.binary()),
                        ],
                        names=[*_KEY, "start", "size", "words"],
                    )

    return run


def hits(docs: DataFrame, items: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, windows, found).

    ``rows`` has doc_id, n_words and the key (k1, k2) of its text for every row
    of ``docs``; ``windows`` the benchmark's windows with item_id; ``found``, for
    every key once, place (word number), size and words of each window of the
    text that is one of the benchmark's.
    """
    asked = items.select("item_id", whole_text().alias("text"))
    windows = stored(asked.mapInArrow(_item_windows(span), schema(asked, ["item_id"], "size int, mark long, words binary")).distinct(), "leak-windows")
    spans = sorted(r.size for r in windows.select(F.col("size").alias("size")).distinct().collect())
    texts = docs.select("doc_id", whole_text().alias("text"))
    texts = texts.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(span), "text")})
    out = schema(texts, ["doc_id", *_KEY], "n_words long, prints array<long>")
    rows = stored(texts.select("doc_id", *_KEY, "text").mapInArrow(_fingerprints(spans), out), "leak-prints")
    # Stored, so that its measured size decides whether it is sent to every task.
    known = stored(windows.select("mark").distinct(), "leak-marks")
    met = rows.select(*_KEY, F.explode("prints").alias("mark")).join(known, "mark", "left_semi")
    met = stored(met.groupBy(*_KEY).agg(F.collect_set("mark").alias("prints")), "leak-met")
    touched = texts.join(met, _KEY).groupBy(*_KEY).agg(F.first("text").alias("text"), F.first("prints").alias("prints"))
    laid = touched.mapInArrow(_candidates(spans), "k1 long, k2 long, start int, size int, words binary")
    found = stored(laid.join(windows.select("words").distinct(), "words", "left_semi"), "leak-found")
    return rows.drop("prints"), windows, found


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_hit (words inside a shared window), item_ids (sorted texts) of the items met, one row per row.

    Null and empty texts have no words, an item without words has no window. An
    item without an id marks words but is not listed; an id that occurs twice is
    listed once. Without benchmark items nothing is hit.
    """
    rows, windows, found = hits(docs, items, span)
    start, end = F.col("start"), F.col("start") + F.col("size")
    order = Window.partitionBy(*_KEY).orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, 0))
    places = found.groupBy(*_KEY, "start").agg(F.max(end).alias("end"))
    covered = places.select(*_KEY, (F.least(reach, F.coalesce(F.lead("start").over(order), reach)) - start).alias("words"))
    n_hit = covered.groupBy(*_KEY).agg(F.sum("words").alias("n_hit"))

    # Texts with the same windows have the same items: they are listed once for all of them.
    mark = F.xxhash64("words")
    sets = found.groupBy(*_KEY).agg(F.sort_array(F.collect_set(F.struct(mark, F.hash("words")))).alias("all"))
    sets = stored(sets.select(*_KEY, F.sha2(F.to_json("all"), 256).alias("set")), "leak-sets")
    first = sets.groupBy("set").agg(F.min(F.struct(*_KEY)).alias("key")).select("set", "key.*")
    of_set = found.join(first, _KEY).select("set", "words").distinct()
    owners = windows.where("item_id is not null").select("words", F.col("item_id").cast("string").alias("item")).distinct()
    lists = of_set.join(owners, "words").groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("item_ids"))

    per_text = n_hit.join(sets, _KEY).join(lists, "set", "left").drop("set")
    return rows.join(per_text, _KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    joined = F.array_join("item_ids", ",").cast("binary")
    return contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(joined, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, w, least({SPAN}, len(w)) AS size, unnest(range(0, len(w) - least({SPAN}, len(w)) + 1)) AS s FROM b WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, size, array_to_string(w[s + 1 : s + size], ' ') AS words FROM cut),
sizes AS (SELECT DISTINCT size FROM windows),
laid AS (SELECT rid, w, size, unnest(range(0, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size),
found AS MATERIALIZED (
  SELECT rid, s, size, words FROM (SELECT rid, s, size, array_to_string(w[s + 1 : s + size], ' ') AS words FROM laid)
  WHERE words IN (SELECT words FROM windows)
),
covered AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(s, s + size)) AS place FROM found) GROUP BY rid),
met AS (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found JOIN windows USING (words) WHERE item_id IS NOT NULL),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM met GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN listed USING (rid)
"""

QUERIES = {
    "op11_decontamination": Query(
        lambda spark, sf_dir: digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")), SQL
    )
}
