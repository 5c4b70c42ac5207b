"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q that holds at least three
periods and can't be extended. Short periods are scanned lag by lag. Longer ones
are dealt into scales of periods ``low..high`` with high at most 1.5 times low.
At a scale, runs of ``high`` words are hashed and the least hash of every window
of ``2 * low - high + 1`` such runs is a minimizer.

Inside a run of period q two windows q apart hold the same hashes and lie within
it, so a minimizer comes back after q places; as it spans a whole period, it
comes back no earlier. So the pairs of successive equal minimizers at distances
``low..high`` contain every period of the scale. A pair is extended by equal
blocks of halving size; if the stretch is long enough, its lag is scanned
word by word, which gives the exact runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, mixed, schema, slices, sliding, table, whole_text

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Periods up to this are scanned directly; every run of at least LEAST_WORDS words repeats a part of so many words.
DIRECT = LEAST_WORDS // LEAST_PERIODS
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

Run = tuple[int, int, int]


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(left + _LEFT) + right * _RIGHT)


class Blocks:
    """Hashes of all blocks of 1, 2, 4, ... words of a text."""

    def __init__(self, ids: np.ndarray) -> None:
        self.n, self.levels = len(ids), [mixed(ids.astype(np.uint64) + _LEFT)]

    def level(self, j: int) -> np.ndarray:
        while len(self.levels) <= j:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(_joined(last[: len(last) - step], last[step:]))
        return self.levels[j]

    def of(self, size: int) -> np.ndarray:
        """Hashes of all blocks of ``size`` words, from two that overlap."""
        j = size.bit_length() - 1
        parts, rest = self.level(j), size - (1 << j)
        return _joined(parts[: len(parts) - rest], parts[rest:])

    def common(self, left: np.ndarray, right: np.ndarray, forward: bool) -> np.ndarray:
        """Length of the equal stretch from (or, backwards, before) each pair of places, left < right."""
        out = np.zeros(len(left), np.int64)
        top = max(0, (self.n // 2).bit_length() - 1)
        for j in range(top, -1, -1):
            step, names = 1 << j, self.level(j)
            while True:
                a, b = (left + out, right + out) if forward else (left - out - step, right - out - step)
                fits = (b + step <= self.n) & (a >= 0)
                same = fits & (names[np.where(fits, a, 0)] == names[np.where(fits, b, 0)])
                out += same * step
                # Below the top at most one block more is equal.
                if j < top or not same.any():
                    break
        return out


def _at_lag(ids: np.ndarray, lag: int) -> Iterator[Run]:
    """All maximal stretches with words ``lag`` apart equal that are long enough and have no smaller period."""
    same = np.concatenate([[False], ids[:-lag] == ids[lag:], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + lag
    for at in np.flatnonzero(lengths >= max(LEAST_WORDS, LEAST_PERIODS * lag)):
        start, length = int(starts[at]), int(lengths[at])
        own = ids[start : start + length]
        # With three periods, a smaller period would divide the lag.
        if not any(np.array_equal(own[: length - lag // f], own[lag // f :]) for f in _primes(lag)):
            yield start, length, lag


def _primes(n: int) -> list[int]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return [*out, n] if n > 1 else out


def _returns(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the minimizers that come back, and the distance to their next place."""
    order = np.argsort(values[:, 1], kind="stable")
    place, value = values[order, 0], values[order, 1]
    again = value[1:] == value[:-1]
    return place[:-1][again].astype(np.int64), (place[1:] - place[:-1])[again].astype(np.int64)


def _minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """(place, hash) of every hash that is the least of a window."""
    least = sliding(np.minimum, hashes, window)
    edge = np.zeros(window - 1, np.uint64)
    chosen = np.flatnonzero(hashes == sliding(np.maximum, np.concatenate([edge, least, edge]), window))
    return np.column_stack([chosen.astype(np.uint64), hashes[chosen]])


def runs(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of every run in a sequence of word numbers, by start and period."""
    n = len(ids)
    if n < LEAST_WORDS:
        return []
    blocks = Blocks(ids)
    if len(np.unique(blocks.of(DIRECT))) == n - DIRECT + 1:
        return []
    found = [r for lag in range(1, DIRECT + 1) for r in _at_lag(ids, lag)]
    low = DIRECT + 1
    while LEAST_PERIODS * low <= n:
        high = min((low - 1) * 3 // 2, n // LEAST_PERIODS)
        places, lags = _returns(_minimizers(blocks.of(high), 2 * low - high + 1))
        if not len(places):
            break
        fit = (lags >= low) & (lags <= high)
        places, lags = places[fit], lags[fit]
        length = blocks.common(places, places + lags, True) + blocks.common(places, places + lags, False) + lags
        for lag in np.unique(lags[length >= LEAST_PERIODS * lags]).tolist():
            found += _at_lag(ids, lag)
        low = high + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def words(text: str) -> list[bytes]:
    """bytes.split knows exactly the six blanks of the word rule."""
    return text.encode("utf-8", "surrogatepass").split()


def numbered(found: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in found), np.int64, len(found))


def collapsed(found: list[bytes], own: list[Run]) -> list[bytes]:
    """The words without those that a run repeats after its first period."""
    if not own:
        return found
    drop = np.zeros(len(found) + 1, np.int64)
    for start, length, period in own:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [found[i] for i in np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period in words, by start and period) and ``collapsed``: the text's words, each
    run reduced to its first period, joined by one space.

    One row per row, whatever its id; null and empty texts have no runs and
    collapse to an empty text. A text is one row in one task.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            lists, short = [], []
            for text in batch.column("text"):
                found = words(text.as_py())
                own = runs(numbered(found))
                lists.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                short.append(b" ".join(collapsed(found, own)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lists, kind), pa.array(short, pa.string())], names=["doc_id", "runs", "collapsed"]
            )

    out = schema(texts, ["doc_id"], "runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return texts.mapInArrow(run, out)


def plant(found: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a text, made periodic from some word on for a tenth of the ids; a null id leaves the text as it is."""
    n, h = len(found), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return found
    g = h // 10
    at = g % n
    period = 1 + (n - at) // (3 + g % 8)
    return found[:at] + [found[at + i % period] for i in range(n - at)]


def _planted(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", whole_text().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = words(text)
                planted = plant(found, key)
                made.append(text if planted is found else b" ".join(planted).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "text"])

    return texts.mapInArrow(run, texts.schema)


def _greatest(own: Column) -> Column:
    """The run with the greatest length / period; the first one of equals, which come by start and period."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(own, nothing, lambda best, r: F.when(better(best, r), r).otherwise(best))


def digests(docs: DataFrame) -> DataFrame:
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = periodic_runs(_planted(docs)).withColumn("best", _greatest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        sha(listed).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {"op12_periodic_runs": Query(lambda spark, sf_dir: digests(table(spark, sf_dir, "documents")))}
