"""Language-model scoring of whole documents.

Word counts cover all training documents. The frequent words (a bounded number)
go to every task; the counts of all others meet the documents in a join. Texts
are read once into numbers of words, which training and scoring share.

The network learns from every training document once. Documents are dealt by a
hash into shards, as many as their tokens ask for, so neither files nor tasks
have a say in the result. Every shard trains from common weights, in the order
of the hash, and the weights are averaged by tokens, a bounded number at a
time: first over an eighth of the documents, then over the rest.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm import recurrent
from quarrystone.llm.common import Query, fold, schema, slices, stored, table, whole_text

HEAD_WORDS = 1_024
KNOWN_WORDS = 65_536
TAIL_CLASSES = 24
SMOOTHING = 0.1
END = b""
# Documents run side by side in lanes; more of them at once keep the lanes full beside a very long one.
PACK_TOKENS = 6_000_000
# Training documents make one shard per so many tokens; averages take so many weights at a time.
SHARD_TOKENS = 4_000_000
FAN_IN = 64
COUNT_ENTRIES = 250_000
CHUNK = 4_096


def words(text: str) -> list[bytes]:
    """Words with ASCII letters in lower case; bytes know exactly the blanks and letters of the rule."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def tail_class(word: bytes) -> int:
    """Words outside the head are classed by their ending."""
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the frequent words, by falling count with the end of a document first, and of the tail classes."""

    known: dict[bytes, int]
    head: int
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    tokens: int
    distinct: int

    @property
    def slots(self) -> int:
        return -(-self.head // recurrent.CLASS_SIZE) * recurrent.CLASS_SIZE

    def initial(self) -> recurrent.Weights:
        counts = np.array([c for c, _ in zip(self.known.values(), range(self.head))], float)
        return recurrent.initial(counts, self.tail_tokens.astype(float))


def count_words(train: DataFrame) -> DataFrame:
    """(word, c) over all texts; every text ends with one empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            for text in batch.column("text"):
                counts.update(words(text.as_py()))
            counts[END] += batch.num_rows
            if len(counts) > COUNT_ENTRIES:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"]
    )


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS, known_words: int = KNOWN_WORDS) -> Vocabulary:
    """Collects the words above the count that leaves at most ``known_words``; no sort, and the rest stays put."""
    level = F.floor(F.log("c") * 64)
    levels = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    least, held = None, 0
    for r in levels:
        held += r["count"]
        if held >= known_words:
            break
        least = r["level"]
    if least is None:
        # So many words share the highest level that they don't all fit: the first ones by count and word.
        found = counts.orderBy(F.desc("c"), "word").limit(known_words).collect()
    else:
        found = counts.where(level >= least).collect()
    ordered = sorted(((bytes(r.word), r.c) for r in found if bytes(r.word) != END), key=lambda x: (-x[1], x[0]))
    end = counts.where(F.col("word") == END).agg(F.sum("c")).first()[0] or 0
    known = {END: end} | dict(ordered)
    head = min(head_words, len(known))
    kind = (F.crc32(F.substring("word", -2, 2)) % TAIL_CLASSES).alias("k")
    tokens, distinct = np.zeros(TAIL_CLASSES, np.int64), np.zeros(TAIL_CLASSES, np.int64)
    for r in counts.groupBy(kind).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        tokens[r.k], distinct[r.k] = r.n, r.v
    total, different = int(tokens.sum()), int(distinct.sum())
    for word, c in list(known.items())[:head]:
        tokens[tail_class(word)] -= c
        distinct[tail_class(word)] -= c > 0
    return Vocabulary(known, head, tokens, distinct, total, different)


class Reader:
    """Texts to word ids, with what counts alone say about them."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.place = {w: i for i, w in enumerate(v.known)}
        self.log_count = np.log10(np.array(list(v.known.values()), float) + SMOOTHING)
        self.seen = np.array(list(v.known.values())) > 0
        self.tail_log = np.log10(v.tail_tokens + SMOOTHING * (v.tail_words + 1))
        self.kind = np.array([tail_class(w) for w in v.known], np.int32)
        self.id = np.where(np.arange(len(v.known)) < v.head, np.arange(len(v.known)), v.slots + self.kind).astype(np.int32)
        self.ending: dict[bytes, int] = {}

    def _tail(self, word: bytes) -> int:
        end = word[-2:]
        if end not in self.ending:
            self.ending[end] = tail_class(end)
        return self.ending[end]

    def _read(self, text: str):
        """(words, places among the known ones, ids for the network, which are unknown, their classes)."""
        found = words(text)
        found.append(END)
        places = np.fromiter(map(self.place.get, found, repeat(-1)), np.int32, len(found))
        ids, unknown = self.id[places], np.flatnonzero(places < 0)
        kinds = np.fromiter((self._tail(found[i]) for i in unknown.tolist()), np.int32, len(unknown))
        ids[unknown] = self.v.slots + kinds
        return found, places, ids, unknown, kinds

    def facts(self, text: str):
        """(ids, sum of known log10 counts, log10 parts of tail words, number of known tokens, other words with counts)."""
        found, places, ids, unknown, kinds = self._read(text)
        known = places[places >= 0]
        tail = known[known >= self.v.head]
        within = self.log_count[tail].sum() - self.tail_log[self.kind[tail]].sum() - self.tail_log[kinds].sum()
        return ids, self.log_count[known].sum(), within, int(self.seen[known].sum()), Counter(found[i] for i in unknown.tolist())


def read(texts: DataFrame, v: Vocabulary) -> DataFrame:
    """(doc_id, hash, text) to the numbers of a text's words and what counts alone say about it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(v)
        for batch in slices(batches, "text"):
            ids, base, within, known, others = zip(*(reader.facts(text.as_py()) for text in batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("hash"),
                    pa.array([x.astype(np.uint16).tobytes() for x in ids], pa.binary()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(within, pa.float64()),
                    pa.array([list(o) for o in others], pa.list_(pa.binary())),
                    pa.array([list(o.values()) for o in others], pa.list_(pa.int64())),
                ],
                names=["doc_id", "hash", "ids", "n_tokens", "known", "base", "within", "words", "times"],
            )

    out = "hash long, ids binary, n_tokens long, known long, base double, within double, words array<binary>, times array<long>"
    return texts.mapInArrow(run, schema(texts, ["doc_id"], out))


def train(rows: DataFrame, v: Vocabulary, rounds: tuple[tuple[int, int], ...] = ((0, 1), (1, 8))) -> recurrent.Weights:
    """Weights after one pass over all rows (hash, ids); ``rounds`` are ranges of the hash modulo 8."""
    weights = v.initial()
    size = recurrent.flat(weights).size
    for low, high in rounds:
        part = F.pmod("hash", F.lit(8))
        shards = max(1, round(v.tokens * (high - low) / 8 / SHARD_TOKENS))
        shard = F.pmod(F.xxhash64("hash"), F.lit(shards)).cast("int").alias("shard")
        dealt = rows.where((part >= low) & (part < high)).select(shard, "hash", "ids").repartition(2 * shards, "shard")
        sums = dealt.groupBy("shard").applyInArrow(_learner(weights), "chunk int, lane int, n double, x binary")
        while shards > 1:
            shards = -(-shards // FAN_IN)
            sums = sums.withColumn("meet", F.expr(f"lane div {FAN_IN}").cast("int"))
            sums = sums.groupBy("chunk", "meet").applyInArrow(_added, "chunk int, lane int, n double, x binary")
        found = sorted(sums.collect(), key=lambda r: r.chunk)
        if found and found[0].n:
            total = np.concatenate([np.frombuffer(r.x, np.float64) / r.n for r in found])
            weights = recurrent.shaped(total[:size], weights)
    return weights


def _added(group: pa.Table) -> pa.Table:
    group = group.sort_by("lane")
    total = np.sum([np.frombuffer(x.as_py(), np.float64) for x in group["x"]], axis=0)
    n = float(np.sum(group["n"].to_numpy()))
    return pa.table(
        {
            "chunk": group["chunk"][:1],
            "lane": group["meet"][:1],
            "n": pa.array([n]),
            "x": pa.array([total.tobytes()], pa.binary()),
        }
    )


def _numbers(ids: pa.Scalar) -> np.ndarray:
    return np.frombuffer(ids.as_py(), np.uint16).astype(np.int32)


def _learner(weights: recurrent.Weights):
    """Trains on one shard and gives its weights times its tokens, in chunks, for the average."""

    def run(shard: pa.Table) -> pa.Table:
        trainer, pack, held = recurrent.Trainer(weights), [], 0
        for ids in shard.sort_by("hash")["ids"]:
            pack.append(_numbers(ids))
            held += len(pack[-1])
            if held >= PACK_TOKENS:
                trainer.learn(pack)
                pack, held = [], 0
        if pack:
            trainer.learn(pack)
        total = recurrent.flat(trainer.w).astype(np.float64) * trainer.tokens
        parts = [total[i : i + CHUNK].tobytes() for i in range(0, len(total), CHUNK)]
        n = len(parts)
        return pa.table(
            {
                "chunk": pa.array(range(n), pa.int32()),
                "lane": pa.array([shard["shard"][0].as_py()] * n, pa.int32()),
                "n": pa.array([float(trainer.tokens)] * n),
                "x": pa.array(parts, pa.binary()),
            }
        )

    return run


def _scorer(weights: recurrent.Weights, kept: list[str]):
    """Replaces the columns ids and within by the model's log10 probability of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held = [], 0
        for batch in slices(batches, "ids"):
            pack.append(batch)
            held += batch.column("ids").nbytes // 2
            if held >= PACK_TOKENS:
                yield scored(pack)
                pack, held = [], 0
        if pack:
            yield scored(pack)

    def scored(pack: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(pack).combine_chunks()
        model = recurrent.log10_likelihoods(weights, [_numbers(x) for x in rows["ids"]]) + rows["within"].to_numpy()
        return rows.select(kept).append_column("model", pa.array(model)).combine_chunks().to_batches()[0]

    return run


def score(docs: DataFrame) -> DataFrame:
    """Base and model log10 probabilities of every document; learns from folds 1 to 9 of 10.

    One row per row; null and empty texts are scored as their end alone. Repeated
    rows are scored each. Without training documents the network keeps its first
    weights and every word is new.
    """
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("hash", F.xxhash64("doc_id", "text"))
    learned = fold(10) != 0
    counts = stored(count_words(texts.where(learned)), "lm-counts")
    v = vocabulary(counts)
    rows = stored(read(texts, v).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    weights = train(rows.where(learned), v)
    rare = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    met = rare.join(counts.select(F.col("word").alias("words"), "c"), "words", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + SMOOTHING)).alias("rare"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    whole = float(np.log10(v.tokens + SMOOTHING * (v.distinct + 1)))
    rare_part = F.coalesce("rare", F.lit(0.0))
    kept = ["row", "doc_id", "n_tokens", "known", "base"]
    modelled = rows.select(*kept, "within", "ids").mapInArrow(_scorer(weights, kept), schema(rows, kept, "model double"))
    return modelled.join(sums, "row", "left").select(
        "doc_id",
        (fold(10) == 0).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare_part - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + rare_part).alias("score"),
    )


QUERIES = {"op5_recurrent_lm": Query(lambda spark, sf_dir: score(table(spark, sf_dir, "documents")))}
