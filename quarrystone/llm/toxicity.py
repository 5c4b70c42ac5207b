"""Toxicity by compression distance.

One zstandard dictionary is made of words of ordinary texts; the other holds the
same and, nearest to what is compressed, the words that toxic texts hold clearly
more often. A window (one word, or 64 characters of a longer one) is compressed
with either dictionary, and the difference of the lengths is what toxic wording
saves. Small differences also come about by chance, in some languages more than
in others, so what a text saves beyond a threshold per window is weighed against
the number of its windows that stay below. The threshold and the weights are
calibrated on labelled documents that took no part in the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, fold, schema, slices, stored, table, whole_text

# The classifier is fitted on at most so many labelled documents of either class, first by a hash of the id.
SAMPLE = 6_000
DICTIONARY_BYTES = 8_192
# The ordinary part is larger: parts of toxic words that ordinary words also have must be found there as well.
ORDINARY_BYTES = 32_768
LEAST_DOCUMENTS = 3
# Twice the log likelihood ratio from which a word's lean to toxic texts isn't put down to chance.
LEAST_EVIDENCE = 16.0
# ... and its share of the strongest word's: below are words of passages that several toxic texts repeat.
EVIDENCE_SHARE = 0.03
WINDOW = 64
THRESHOLD = 0.3
LEVEL = 9
TABLE_BITS = 17
# Every window stands between these: very short input is stored as it is, and no match begins in its last bytes.
HEAD, TAIL = " window window ", " qzx qzx qzx"
# Thresholds in bytes that the calibration chooses from.
THRESHOLDS = (0, 1, 2, 3, 4)


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs; a few tens of kilobytes."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    least: int = 0

    def score(self, savings: np.ndarray) -> np.ndarray:
        return _probability(features(savings, self.least), np.array(self.weights))


def _probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def pieces(text: str) -> set[str]:
    """The distinct windows of a text: words, and of longer ones parts of WINDOW characters that overlap by half."""
    out: set[str] = set()
    for word in set(text.lower().split()):
        out.update([word] if len(word) <= WINDOW else [word[i : i + WINDOW] for i in range(0, len(word), WINDOW // 2)])
    return out


class Windows:
    """Remembers the difference of the compressed lengths per distinct window."""

    LIMIT = 150_000

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        import zstandard as z

        # Match tables with room to spare: words of one part of a dictionary must not push out those of another.
        tables = z.ZstdCompressionParameters.from_level(
            LEVEL, hash_log=TABLE_BITS, chain_log=TABLE_BITS, window_log=TABLE_BITS,
            write_content_size=False, write_checksum=False, write_dict_id=False,
        )

        def primed(content: bytes):
            words = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=tables)
            return z.ZstdCompressor(dict_data=words, compression_params=tables)

        self._either = primed(ordinary).compress, primed(toxic).compress
        self._known: dict[str, int] = {}

    def __call__(self, window: str) -> int:
        known = self._known.get(window)
        if known is None:
            if len(self._known) >= self.LIMIT:
                self._known.clear()
            data = (HEAD + window + TAIL).encode("utf-8", "surrogatepass")
            known = self._known[window] = len(self._either[0](data)) - len(self._either[1](data))
        return known

    def savings(self, text: str) -> list[int]:
        """Bytes saved beyond t in each distinct window, added up, for t from 0 to the largest of THRESHOLDS plus 2."""
        out = [0] * (THRESHOLDS[-1] + 3)
        for window in pieces(text):
            d = self(window)
            for t in range(min(d, len(out))):
                out[t] += d - t
        return out


def features(savings: np.ndarray, least: int) -> np.ndarray:
    """Per document: constant, what its windows save beyond ``least`` bytes and beyond two more, and how many save less."""
    above = savings[:, :-1] - savings[:, 1:]  # windows that save more than t
    below = above[:, 0] - above[:, max(least, 1)]
    return np.column_stack([np.ones(len(savings)), *np.log1p([savings[:, least], savings[:, least + 2], below])])


def sample(labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """At most ``bound`` labelled ids of either class, dealt into two halves."""
    known = _labelled(labels).withColumn("h", F.xxhash64("doc_id"))
    parts = [known.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(bound) for c in (0, 1)]
    return parts[0].unionByName(parts[1]).select("doc_id", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("half"))


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per labelled document; of contradicting labels the toxic one counts."""
    known = labels.where("doc_id is not null and toxic in (0, 1)")
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def _family(words: list[str]) -> int:
    """A value that copies of a text mostly share: the least hash of its five-word runs, or of a shorter text."""
    import xxhash

    runs = range(max(1, len(words) - 4))
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5]).encode("utf-8", "surrogatepass")) for i in runs) - 2**63


def _with_family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        families = pa.array([_family(t.as_py().lower().split()) for t in batch.column("text")], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, families], names=[*batch.schema.names, "family"])


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct windows of each text with the text's other columns."""
    for batch in slices(batches, "text"):
        held = [pieces(t.as_py()) for t in batch.column("text")]
        row = pa.array([i for i, found in enumerate(held) for _ in found], pa.int32())
        found = pa.array([w for found in held for w in found], pa.string())
        yield pa.RecordBatch.from_arrays(
            [found, batch.column("toxic").take(row), batch.column("half").take(row)], names=["word", "toxic", "half"]
        )


def _dictionaries(counted: DataFrame, in_toxic: Column, in_ordinary: Column, n1: int, n0: int) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary from document counts of words."""
    p1, p0, p = (in_toxic + 0.5) / (n1 + 1), (in_ordinary + 0.5) / (n0 + 1), (in_toxic + in_ordinary + 1) / (n1 + n0 + 2)
    evidence = 2 * (in_toxic * F.log(p1 / p) + in_ordinary * F.log(p0 / p))
    lean = (in_toxic >= LEAST_DOCUMENTS) & (p1 > 4 * p0)
    strongest = counted.where(lean).agg(F.max(evidence)).first()[0] or 0.0
    clear = lean & (evidence >= max(LEAST_EVIDENCE, EVIDENCE_SHARE * strongest))

    def content(rows: DataFrame, rank: Column, size: int) -> str:
        """The first words by rank that fit, the most telling last, where matches are nearest."""
        best = [r.word for r in rows.orderBy(rank.desc(), "word").limit(size // 2).select("word").collect()]
        ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in best])
        return " ".join(reversed(best[: int(np.searchsorted(ends, size, side="right"))]))

    # The line feed keeps the head from matching on into the first word.
    ordinary = HEAD * 2 + "\n" + content(counted.where((in_ordinary > 0) & (p1 <= 4 * p0)), p0, ORDINARY_BYTES) + " "
    toxic = content(counted.where(clear), p1 * F.log(p1 / p0), DICTIONARY_BYTES)
    # Forwards and back, so that an entry overwritten in the match tables has a second chance.
    toxic = " ".join([*reversed(toxic.split(" ")), toxic]) + " "
    return (ordinary + HEAD).encode("utf-8", "surrogatepass"), (ordinary + toxic + HEAD).encode("utf-8", "surrogatepass")


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """Fits dictionaries and calibration. Without enough labels of both classes every document scores near 0.

    The ids of the sample are few by ``bound`` and are broadcast; words are
    counted by documents in the tasks, and only those that go into a dictionary
    reach the driver, as do a handful of numbers per calibrated document. The
    calibration sees each half through dictionaries of the other half.
    """
    nothing = Model(b"", b"", ())
    totals = {r.toxic: r.n for r in _labelled(labels).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = F.broadcast(sample(labels, bound))
    texts = docs.select("doc_id", whole_text().alias("text")).join(chosen, "doc_id").select("text", "toxic", "half")
    # Copies of one text would lend its rare words the weight of many documents.
    texts = stored(texts.mapInArrow(_with_family, schema(texts, texts.columns, "family long")).dropDuplicates(["toxic", "family"]), "toxicity-sample")
    sizes = {(r.toxic, r.half): r.n for r in texts.groupBy("toxic", "half").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 4:
        return nothing
    cells = [(c, h) for c in (0, 1) for h in (0, 1)]
    counted = stored(
        texts.mapInArrow(_document_words, "word string, toxic int, half int")
        .groupBy("word")
        .agg(*(F.count_if((F.col("toxic") == c) & (F.col("half") == h)).alias(f"n{c}{h}") for c, h in cells))
        .where("n00 + n01 + n10 + n11 >= 2"),
        "toxicity-words",
    )
    savings, marks = [], []
    for half in (0, 1):
        ordinary, toxic = _dictionaries(counted, F.col(f"n1{half}"), F.col(f"n0{half}"), sizes[1, half], sizes[0, half])
        other = texts.where(F.col("half") != half).select("text", "toxic")
        for r in other.mapInArrow(_counter(ordinary, toxic, "toxic"), "toxic int, savings array<long>").collect():
            savings.append(r.savings)
            marks.append(r.toxic)
    x, y = np.array(savings, float), np.array(marks, float)
    # The sample holds the classes in other shares than the labels do.
    weigh = np.where(y == 1, totals[1] / y.sum(), totals[0] / (1 - y).sum())
    least, weights = _calibrated(x, y, weigh / weigh.mean())
    both = lambda c: F.col(f"n{c}0") + F.col(f"n{c}1")
    ordinary, toxic = _dictionaries(counted, both(1), both(0), sizes[1, 0] + sizes[1, 1], sizes[0, 0] + sizes[0, 1])
    return Model(ordinary, toxic, tuple(weights), least)


def _calibrated(savings: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> tuple[int, list[float]]:
    """The threshold per window under which the labels are likeliest, the smaller of equal ones, and its weights."""
    fits = []
    for least in THRESHOLDS:
        x = features(savings, least)
        weights = _logistic(x, y, weigh)
        p = _probability(x, np.array(weights))
        fits.append((-float(weigh @ np.log(np.where(y == 1, p, 1 - p))), least, weights))
    return min(fits)[1:]


def _logistic(x: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> list[float]:
    """Weights by Newton steps under a small penalty."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weigh * (p - y)) + penalty @ w
        w -= np.linalg.solve((x * (weigh * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), gradient)
    return w.tolist()


def _counter(ordinary: bytes, toxic: bytes, kept: str):
    """(text, kept) to (kept, savings)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(ordinary, toxic)
        for batch in slices(batches, "text"):
            savings = [windows.savings(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(kept), pa.array(savings, pa.list_(pa.int64()))], names=[kept, "savings"]
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All rows and columns of ``docs`` with ``toxicity`` (double, 0 to 1) added. Null text counts as empty."""
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(model.ordinary, model.toxic) if model.ordinary else None
        for batch in slices(batches, "text"):
            if windows is None:
                scores = np.zeros(batch.num_rows)
            else:
                savings = np.array([windows.savings(t.as_py() or "") for t in batch.column(at)], float)
                scores = model.score(savings.reshape(batch.num_rows, -1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, "toxicity"])

    return docs.mapInArrow(run, schema(docs, names, "toxicity double"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from the labels of folds 0, 1 and 3 of 4 and scores all documents."""
    model = train(docs, labels.where(fold(4) != 2))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {
    "op10_toxicity": Query(lambda spark, sf_dir: classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
}
