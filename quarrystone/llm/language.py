"""Language identification by hyperdimensional profiles.

Every letter of any script has a vector of +1 and -1 of its own, from its code
point. The vectors of a trigram's letters are permuted by their place and bound
by multiplication; the vectors of a text's trigrams are bundled by addition. A
language's prototype bundles the trigrams of all its training texts, and a text
gets the language of the nearest prototype by cosine.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, fold, mixed, schema, slices, table, whole_text

DIMENSIONS = 512
SEED = 20_011
UNKNOWN = "und"
# A trigram is one number: three code points of 21 bits, 0 for a word end.
POINT_BITS = 21
# Distinct trigrams held at a time; they bound memory and change no result.
TRAIN_GRAMS = 1 << 20
KNOWN_GRAMS = 1 << 14
BUNDLED_GRAMS = 1 << 12


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Every code point that is a letter as itself, all others as 0."""
    return np.array([p if chr(p).isalpha() else 0 for p in range(0x110000)], np.int64)


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """A vector of +1 and -1 per code point, from bits seeded by the code point."""
    parts = -(-dimensions // 64)
    counters = points.astype(np.uint64)[:, None] * np.uint64(parts) + np.arange(parts, dtype=np.uint64)
    with np.errstate(over="ignore"):
        bits = mixed(mixed((counters + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(SEED))
    return np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1)[:, :dimensions].astype(np.int8) * 2 - 1


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of trigrams."""
    low = (1 << POINT_BITS) - 1
    points, at = np.unique(np.concatenate([grams >> 2 * POINT_BITS, grams >> POINT_BITS & low, grams & low]), return_inverse=True)
    letters = letter_vectors(points, dimensions)
    first, second, third = np.split(at, 3)
    return np.roll(letters, 2, 1)[first] * np.roll(letters, 1, 1)[second] * letters[third]


def trigrams(text: str) -> np.ndarray:
    """All trigrams of the words of a text, with one word end on either side; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[0], _letters()[points], [0]])
    letters = letters[np.concatenate([[True], (letters[1:] != 0) | (letters[:-1] != 0)])]
    if len(letters) < 3:
        return np.zeros(0, np.int64)
    grams = (letters[:-2] << 2 * POINT_BITS) | (letters[1:-1] << POINT_BITS) | letters[2:]
    return grams[letters[1:-1] != 0]


class Bundler:
    """Bundles counted trigrams; vectors of the last ``KNOWN_GRAMS`` or fewer distinct ones are kept."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self._forget()

    def _forget(self) -> None:
        self.grams, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.zeros((KNOWN_GRAMS, self.dimensions), np.float32)

    def _vectors(self, grams: np.ndarray) -> np.ndarray:
        if len(grams) > KNOWN_GRAMS:
            return gram_vectors(grams, self.dimensions).astype(np.float32)
        at = np.searchsorted(self.grams, grams)
        known = np.zeros(len(grams), bool)
        inside = at < len(self.grams)
        known[inside] = self.grams[at[inside]] == grams[inside]
        new = grams[~known]
        if len(self.grams) + len(new) > KNOWN_GRAMS:
            self._forget()
            return self._vectors(grams)
        if len(new):
            held = len(self.grams)
            self.vectors[held : held + len(new)] = gram_vectors(new, self.dimensions)
            where = np.searchsorted(self.grams, new)
            self.grams = np.insert(self.grams, where, new)
            self.places = np.insert(self.places, where, np.arange(held, held + len(new)))
            at = np.searchsorted(self.grams, grams)
        return self.vectors[self.places[at]]

    def __call__(self, grams: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Sum of the vectors of distinct ordered trigrams, each ``n`` times."""
        total = np.zeros(self.dimensions, np.float64)
        for i in range(0, len(grams), BUNDLED_GRAMS):
            total += n[i : i + BUNDLED_GRAMS].astype(np.float32) @ self._vectors(grams[i : i + BUNDLED_GRAMS])
        return total


def _counts(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    ordered = np.sort(grams)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[at], np.diff(np.append(at, len(ordered)))


def _added(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the distinct values of both."""
    grams, at = np.unique(np.concatenate([one[0], other[0]]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([one[1], other[1]]), len(grams)).astype(np.int64)


def train(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Prototypes (lang, vector) from all rows with a language and a letter.

    Trigrams are counted per language and task before they are summed, and
    their vectors are bundled once per language and trigram.
    """
    texts = docs.where("lang is not null").select("lang", whole_text().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, "text"):
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found.setdefault(lang, []).append(trigrams(text.as_py()))
            for lang, parts in found.items():
                counts = _counts(np.concatenate(parts))
                totals[lang] = _added(totals[lang], counts) if lang in totals else counts
            if sum(len(grams) for grams, _ in totals.values()) > TRAIN_GRAMS:
                yield from map(counted, totals, totals.values())
                totals.clear()
        yield from map(counted, totals, totals.values())

    def counted(lang: str, totals: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        grams, n = totals
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, grams, n = np.array(batch.column(0).to_pylist()), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lang in np.unique(langs):
                own = langs == lang
                part = n[own].astype(np.float64) @ gram_vectors(grams[own], dimensions).astype(np.float64)
                sums[lang] = sums.get(lang, 0) + part
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([str(lang)] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(total)],
                names=["lang", "i", "x"],
            )

    grams = texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    cells = grams.mapInArrow(bundle, "lang string, i int, x double").groupBy("lang", "i").agg(F.sum("x").alias("x"))
    return cells.groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vector")
    )


def predict(docs: DataFrame, prototypes: list[tuple[str, list[float]]], id_column: str = "doc_id") -> DataFrame:
    """``lang_pred`` and ``score`` (cosine, at least 0) of every row of ``docs``.

    Without a letter or without any prototype the language is ``und`` and the
    score 0; ties go to the language that sorts first. Only the text is read.
    """
    names = [lang for lang, _ in sorted(prototypes)]
    matrix = np.array([vector for _, vector in sorted(prototypes)], np.float64)
    dimensions = matrix.shape[-1] if names else 0
    texts = docs.select(F.col(id_column).alias("id"), whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = (matrix / np.maximum(np.linalg.norm(matrix, axis=-1, keepdims=True), 1e-12)).astype(np.float32)
        bundled = Bundler(dimensions)
        for batch in slices(batches, "text"):
            langs, scores = [], []
            for value in batch.column("text"):
                grams, n = _counts(trigrams(value.as_py())) if names else ([], [])
                if not len(grams):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = bundled(grams, n)
                cosines = directions @ vector / max(float(np.linalg.norm(vector)), 1e-12)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(np.clip(cosines[best], 0, 1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    return texts.mapInArrow(run, schema(texts, ["id"], "lang_pred string, score double")).withColumnRenamed("id", id_column)


def identify(docs: DataFrame) -> DataFrame:
    """Learns from fold 0, 1 and 3 of 4 and predicts all rows; languages are few, so prototypes go to every task."""
    prototypes = [(r.lang, list(r.vector)) for r in train(docs.where(fold(4) != 2)).collect()]
    return predict(docs, prototypes).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_language": Query(lambda spark, sf_dir: identify(table(spark, sf_dir, "documents")))}
