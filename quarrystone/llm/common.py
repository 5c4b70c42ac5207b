"""What the operators share: word rules, folds, scratch tables and vocabulary files."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrystone.session import scratch_dir

# White space of the word rule [^\x20\x09-\x0D]+.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Has rows go to Python in batches of a thousand rows and a few megabytes at most: batches are held on both sides.

    The settings stay in the session; they bound memory and change no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def schema(frame: DataFrame, columns: list[str], more: str) -> StructType:
    """The named columns of a frame and further ones given as DDL."""
    return StructType([*(frame.schema[c] for c in columns), *StructType.fromDDL(more).fields])


def whole_text(column: str = "text") -> Column:
    """A text with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(folds: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % folds


def words(text: Column) -> Column:
    """Array of the words of a text in order; empty for a text without words."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


_MADE: list[list[str]] = []


@contextlib.contextmanager
def scratch_paths() -> Iterator[list[str]]:
    """The paths of the tables that ``stored`` writes inside, in their order."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE.remove(made)


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Removes stored tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: recomputed by nobody, lost with no executor."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    for made in _MADE:
        made.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with at most ``limit`` bytes or items in a column, or one row.

    Python objects made from a batch take a multiple of its size, so large
    batches are worked off in parts.
    """
    for batch in batches:
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        ends = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads unsigned 64-bit values; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sliding(least: np.ufunc, values: np.ndarray, size: int) -> np.ndarray:
    """``np.minimum`` or ``np.maximum`` over every window of ``size`` values, by doubling."""
    held = 1
    while held < size:
        step = min(held, size - held)
        values = least(values[: len(values) - step], values[step:])
        held += step
    return values


@functools.lru_cache(maxsize=4)
def rank_file(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a file of base64 and number lines."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
