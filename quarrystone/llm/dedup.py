"""Near-duplicate components by MinHash with sequential Bayesian verification.

1. Texts with equal shingle sets form a class; one row stands for it.
2. Classes meet in the buckets of banded MinHash signatures.
3. In every bucket each class is paired with one leader: the class with the
   smallest share of shingles that no other bucketed class has.
4. Candidate pairs compare their signatures batch by batch and are given up as
   soon as the posterior probability of the wanted similarity falls below the
   chosen miss probability; survivors are verified on the full sets.
5. Links join classes to components. What is left in a bucket outside its
   leader's component is paired with the other components of the bucket, unless
   an exact bound rules a link out: an intersection holds no shingle that only
   one set has, and of those that few sets have only what the pair itself
   shares. So copies that are linked already are never paired again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, mixed, schema, slices, stored, table, whole_text

BATCH = 30
# A shingle in at most so many bucketed sets is rare: the pairs that share it are listed, not bounded.
RARE = 16
# Members of a bucket are dealt into tiles of about so many; every pair of tiles is a group of its own.
TILE = 256


@dataclass(frozen=True)
class Settings:
    """Shingle width in words, least similarity in percent, and how sure the search is to find a link."""

    width: int = 3
    percent: int = 85
    band_miss: float = 1e-5
    prune_miss: float = 1e-6

    @property
    def rows(self) -> int:
        return 7 if self.percent >= 85 else 6

    @property
    def bands(self) -> int:
        """So many that a pair at the least similarity shares none with probability ``band_miss``."""
        return math.ceil(math.log(self.band_miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def hashes(self) -> int:
        return self.rows * self.bands


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit values of the word runs of a text, ASCII letters in lower case.

    A text with fewer words than ``width`` is one run; without a word it has none.
    """
    import xxhash

    # bytes.lower and bytes.split know exactly the ASCII letters and the six blanks of the word rule.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        runs = mixed(runs + each[i : i + len(runs)])
    return np.unique(runs)


def signature(values: np.ndarray, hashes: int) -> np.ndarray:
    """Least value of each of ``hashes`` hash functions over a non-empty set."""
    numbers = np.random.default_rng(8_191).integers(0, 2**63, (2, hashes), dtype=np.uint64)
    factor, shift = numbers[0] * np.uint64(2) + np.uint64(1), numbers[1]
    least = np.full(hashes, 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for i in range(0, len(values), 256):
            part = (values[i : i + 256, None] * factor + shift) >> np.uint64(32)
            least = np.minimum(least, part.min(axis=0).astype(np.uint32))
    return least


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(hashes compared, least number of matches with which a pair goes on).

    With a uniform prior, P(similarity >= t | m of n) is the chance of at most m
    successes in n + 1 trials of chance t.
    """
    t, out = settings.percent / 100, []
    for n in [*range(BATCH, settings.hashes, BATCH), settings.hashes]:
        total, m = 0.0, 0
        while m <= n:
            total += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(t) + (n + 1 - m) * math.log1p(-t)
            )
            if total >= settings.prune_miss:
                break
            m += 1
        out.append((n, m))
    return out


def _keyed_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and further columns with a key of two hashes of the text."""
    texts = docs.select("doc_id", *more, whole_text().alias("text"))
    return texts.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})


def _features(docs: DataFrame, s: Settings, keep: tuple[str, ...]) -> DataFrame:
    """doc_id, columns to keep, key of the text, n, set hash and signature of every row."""
    names = ["doc_id", *keep, "k1", "k2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "text"):
            sets = [shingles(t.as_py(), s.width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                    pa.array([signature(x, s.hashes).tobytes() if len(x) else b"" for x in sets], pa.binary()),
                ],
                names=[*names, "n", "hash", "sig"],
            )

    texts = _keyed_texts(docs, *keep)
    return texts.mapInArrow(run, schema(texts, names, "n long, hash binary, sig binary"))


def _buckets(classes: DataFrame, s: Settings) -> DataFrame:
    """(c, bucket) per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sig"):
            sigs = np.stack([np.frombuffer(x.as_py(), np.uint32) for x in batch.column("sig")]).astype(np.uint64)
            for band in range(s.bands):
                value = np.full(len(sigs), band + 1, np.uint64)
                for i in range(band * s.rows, (band + 1) * s.rows):
                    value = mixed(value + sigs[:, i] + np.uint64(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(value.view(np.int64))], names=["c", "bucket"])

    return classes.select("c", "sig").mapInArrow(run, "c long, bucket long")


def _sets(docs: DataFrame, wanted: DataFrame, s: Settings) -> DataFrame:
    """(c, items) of the wanted classes (c, rep, hash), from the texts that stand for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "text"):
            sets = [shingles(t.as_py(), s.width).tobytes() for t in batch.column("text")]
            same = [xxhash.xxh3_128_digest(x) == h.as_py() for x, h in zip(sets, batch.column("hash"))]
            made = pa.RecordBatch.from_arrays([batch.column("c"), pa.array(sets, pa.binary())], names=["c", "items"])
            yield made.filter(pa.array(same))

    rep = wanted.select("c", "hash", F.col("rep.doc_id").alias("rep_id"), F.col("rep.k1").alias("k1"), F.col("rep.k2").alias("k2"))
    texts = _keyed_texts(docs).join(rep, ["k1", "k2"])
    met = texts.where(F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("c", "hash", "text")
    # Rows that repeat a document's id and text, or a text without an id, give the same set again.
    return met.mapInArrow(run, "c long, items binary").dropDuplicates(["c"])


def _promising(pairs: DataFrame, sigs: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) that the sequential comparison doesn't give up."""
    steps = least_matches(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "sig_a"):
            left, right = (
                np.stack([np.frombuffer(x.as_py(), np.uint32) for x in batch.column(side)]) for side in ("sig_a", "sig_b")
            )
            alive, matches, done = np.arange(len(left)), np.zeros(len(left), int), 0
            for n, least in steps:
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, done = alive[matches[alive] >= least], n
            yield batch.select(["a", "b"]).take(pa.array(alive))

    both = pairs.join(sigs.select(F.col("c").alias("a"), F.col("sig").alias("sig_a")), "a")
    both = both.join(sigs.select(F.col("c").alias("b"), F.col("sig").alias("sig_b")), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "items_a"):
            keep = []
            for x, y in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= s.percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("items").alias("items_a")), "a")
    both = both.join(sets.select(F.col("c").alias("b"), F.col("items").alias("items_b")), "b")
    return both.select("a", "b", "items_a", "items_b").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(c, label): the least member of each linked member's component.

    Every round takes the least label among neighbours and then the label of the
    label, so that chains shorten by doubling; rounds are stored.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "dedup-edges")
    labels = stored(edges.groupBy(F.col("a").alias("c")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "dedup-labels")
    while True:
        near = edges.join(labels.select(F.col("c").alias("b"), "label"), "b").groupBy(F.col("a").alias("c")).agg(F.min("label").alias("near"))
        nearer = labels.join(near, "c").select("c", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("c").alias("next"), F.col("label").alias("further"))
        moved = nearer.join(jump, "next").select("c", F.col("label").alias("old"), F.least("next", "further").alias("label"))
        moved = stored(moved, "dedup-labels")
        labels = moved.select("c", "label")
        if moved.where("label != old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id of the component) and kept (doc_id = component_id), with the columns
    of ``keep`` and ``component``, a number per component (null for texts without words).

    One row per row of ``docs``. Texts without words are linked with nothing.
    Rows with a null doc_id link like others, also between others, but lend no
    id: a component of only such rows has a null id, and they are kept. Repeated
    rows share a component.
    """
    s = settings
    numbered = _features(docs, s, keep).withColumn("row", F.monotonically_increasing_id())
    # The numbers are stored before they are used, so they never change.
    features = stored(numbered, "dedup-features")
    # The row that stands for a class: the one with the least id, if any has one.
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "k1", "k2", "row")
    made = features.where("n > 0").groupBy("hash", "n").agg(F.min(order).alias("rep"))
    classes = stored(made.withColumn("c", F.monotonically_increasing_id()), "dedup-classes")
    sigs = features.select("row", "sig").join(classes.select("c", F.col("rep.row").alias("row")), "row").select("c", "sig")
    sigs = stored(sigs, "dedup-signatures")

    entries = stored(_buckets(sigs, s), "dedup-bands")
    shared = entries.groupBy("bucket").count().where("count > 1").select("bucket")
    members = stored(entries.join(shared, "bucket"), "dedup-members")
    wanted = members.select("c").distinct().join(classes, "c").select("c", "rep", "hash")
    sets = stored(_sets(docs, wanted, s), "dedup-sets")

    alone = _own_shingles(sets)
    facts = members.select("c").distinct().join(classes.select("c", "n"), "c").join(alone, "c", "left")
    facts = stored(facts.select("c", "n", F.coalesce("own", F.lit(0)).alias("own")), "dedup-facts")
    known = stored(members.join(facts, "c"), "dedup-known")
    best = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), F.col("c").alias("leader"))).alias("best")
    leaders = known.groupBy("bucket").agg(best).select("bucket", "best.leader")
    least, most = F.least("c", "leader").alias("a"), F.greatest("c", "leader").alias("b")
    star = known.join(leaders, "bucket").where("c != leader").select(least, most).distinct()
    star = stored(star, "dedup-star")
    links = stored(_verified(_promising(star, sigs, s), sets, s), "dedup-links")
    labels = components(links)

    rest = _unlinked_pairs(known, labels, sets, s)
    rest = stored(rest.join(star, ["a", "b"], "left_anti"), "dedup-rest")
    more = stored(_verified(_promising(rest, sigs, s), sets, s), "dedup-more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    named = classes.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    least_id = named.groupBy("label").agg(F.min("rep.doc_id").alias("component_id"))
    of_class = named.join(least_id, "label").select("hash", "component_id", F.col("label").alias("component"))
    rows = features.select("doc_id", *keep, "n", "hash")
    placed = rows.join(of_class, "hash", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.select("doc_id", *keep, F.col("n").alias("n_shingles"), component.alias("component_id"), "component").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _items(sets: DataFrame) -> DataFrame:
    """(c, item): the shingles of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "items"):
            items = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("items")]
            row = pa.array(np.repeat(np.arange(len(items)), [len(x) for x in items]))
            yield pa.RecordBatch.from_arrays([batch.column("c").take(row), pa.array(np.concatenate(items))], names=["c", "item"])

    return sets.select("c", "items").mapInArrow(run, "c long, item long")


def _own_shingles(sets: DataFrame) -> DataFrame:
    """(c, own): how many shingles of a class are in no other set."""
    single = _items(sets).groupBy("item").agg(F.count("*").alias("sets"), F.min("c").alias("c")).where("sets = 1")
    return single.groupBy("c").agg(F.count("*").alias("own"))


def _still_open(placed: DataFrame, usable: str, s: Settings) -> DataFrame:
    """Rows (bucket, c, label, n, ...) whose usable shingles allow a link to another component of the bucket.

    With p = percent / 100, a link needs an intersection of p / (1 + p) of both
    sizes together. ``reach`` is the largest partner that a class allows; the
    smallest of the bucket must be within.
    """
    reach = F.col(usable) * ((100 + s.percent) / s.percent) - F.col("n") + 1e-6
    bucket = lambda rows: rows.groupBy("bucket").agg(F.min("n").alias("least"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = bucket(placed).where("low != high").select("bucket", "least")
    near = placed.withColumn("reach", reach).join(mixed, "bucket").where("reach >= least").drop("least")
    return near.join(bucket(near).where("low != high").select("bucket"), "bucket")


def _unlinked_pairs(known: DataFrame, labels: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs of bucketed classes in different components that may still be similar enough.

    Every such pair either has enough frequent shingles on both sides, or shares
    rare ones too; the first kind meets in its first common bucket, the second
    at its rare shingles.
    """
    placed = known.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    placed = placed.withColumn("shared", F.col("n") - F.col("own"))
    open_ = stored(_still_open(placed, "shared", s), "dedup-open")
    classes = open_.select("c", "label", "n", "shared").distinct()
    few = _items(sets).groupBy("item").count().where(f"count > 1 and count <= {RARE}").select("item")
    rare = stored(_items(sets.join(classes.select("c"), "c")).join(few, "item"), "dedup-rare")
    counted = classes.join(rare.groupBy("c").agg(F.count("*").alias("rare")), "c", "left")
    counted = counted.withColumn("frequent", F.col("shared") - F.coalesce("rare", F.lit(0)))
    facts = stored(counted.select("c", "label", "n", "frequent"), "dedup-frequent")
    as_a, as_b = ({x: f"{x}_{side}" for x in ("label", "n", "frequent", "reach", "all")} | {"c": side} for side in "ab")

    often = _still_open(open_.select("bucket", "c", "label", "n").join(facts.select("c", "frequent"), "c"), "frequent", s)
    often = stored(often, "dedup-often")
    lists = often.groupBy("c").agg(F.sort_array(F.collect_list("bucket")).alias("all"))
    listed = stored(often.join(lists, "c"), "dedup-listed")
    # A bucket of many is dealt into tiles, whose pairs come from different tasks.
    tiles = often.groupBy("bucket").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    listed = listed.join(tiles, "bucket").withColumn("own", F.pmod(F.xxhash64("c"), F.col("tiles")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    left = listed.withColumnsRenamed(as_a).withColumns({"i": F.col("own"), "j": others}).drop("own", "tiles")
    right = listed.withColumnsRenamed(as_b).withColumns({"j": F.col("own"), "i": others}).drop("own", "tiles")
    first = F.array_min(F.array_intersect("all_a", "all_b"))
    met = left.join(right, ["bucket", "i", "j"]).where("a < b and label_a != label_b and n_b <= reach_a and n_a <= reach_b")
    met = met.where(F.col("bucket") == first).select("a", "b")

    index = rare.join(facts, "c")
    left, right = index.withColumnsRenamed(as_a), index.withColumnsRenamed(as_b)
    both = left.join(right, "item").where("a < b and label_a != label_b")
    common = both.groupBy("a", "b").agg(F.count("*").alias("common"), *(F.first(x).alias(x) for x in ("n_a", "n_b", "frequent_a", "frequent_b")))
    most = F.least("frequent_a", "frequent_b") + F.col("common")
    close = common.where(most * (100 + s.percent) >= s.percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")
    return met.unionByName(close).distinct()


def _of_documents(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


# All pairs that share a shingle, and the least id by spreading it over links until nothing changes.
SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
cut AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, 1))) AS s FROM d WHERE len(w) > 0),
items AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 3], ' ') AS item FROM cut),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM items GROUP BY doc_id),
common_items AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM items AS x JOIN items AS y ON x.item = y.item AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common_items JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT doc_id, doc_id FROM d),
reach AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least AS component_id, doc_id = least AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) USING (doc_id)
"""

QUERIES = {"op8_near_duplicates": Query(lambda spark, sf_dir: _of_documents(table(spark, sf_dir, "documents")), SQL)}
