"""Vector code compression: integer product codes found by Walsh-Hadamard transforms.

Components become whole numbers, vectors are cut into equal consecutive parts
and every part position has a codebook. Distances are compared in the transformed
space: with H the Walsh-Hadamard matrix of order m, |Hx - Hc|^2 = m |x - c|^2, and
everything stays an integer. Squared differences are added in sequency order,
slow sign patterns first, where the difference of smooth parts gathers. The
distance to the entry that looks best after the first of them bounds the
least one; entries whose partial sum exceeds it are out.

A round is one pass over the stored whole numbers: tasks return a sum and a count
per codebook entry and component, which Spark adds up; only those (entries times
vector length) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.llm.common import Query, schema, stored, table
from quarrystone.llm.topk import whole_components

LONG = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def sequency_order(m: int) -> np.ndarray:
    """Rows of the Walsh-Hadamard matrix of order m (a power of two) by their number of sign changes."""
    rows = transformed(np.eye(m, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transformed(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform along the last axis, whose length is a power of two."""
    shape, m, step = x.shape, x.shape[-1], 1
    while step < m:
        x = x.reshape(*shape[:-1], m // (2 * step), 2, step)
        x = np.stack([x[..., 0, :] + x[..., 1, :], x[..., 0, :] - x[..., 1, :]], axis=-2).reshape(shape)
        step *= 2
    return x


def padded(x: np.ndarray) -> np.ndarray:
    """Zeros up to the next power of two along the last axis."""
    m = 1 << max(0, x.shape[-1] - 1).bit_length()
    return np.concatenate([x, np.zeros((*x.shape[:-1], m - x.shape[-1]), x.dtype)], axis=-1)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each row; ties go to the lower index."""
    both = np.concatenate([book, rows])
    both = padded(both.astype(np.int64 if _small(both) else object))
    m = both.shape[1]
    both = transformed(both)[:, sequency_order(m)]
    entries, x = both[: len(book)], both[len(book) :]
    cut = max(1, m // 4)
    square = lambda d: (d * d).sum(axis=-1)
    partial = square(x[:, None, :cut] - entries[None, :, :cut])
    guess = partial.argmin(axis=1)
    bound = square(x - entries[guess])
    row, entry = np.nonzero(partial <= bound[:, None])
    total = partial[row, entry]
    while cut < m:
        end = min(m, 2 * cut)
        total = total + square(x[row, cut:end] - entries[entry, cut:end])
        open_ = total <= bound[row]
        row, entry, total, cut = row[open_], entry[open_], total[open_], end
    # What is left comes by row and entry; every row has its first guess left.
    starts = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(total, starts) if len(x) else total
    first = np.flatnonzero(total == least[row])
    first = first[np.searchsorted(row[first], np.arange(len(x)))]
    return entry[first], least // m


def _small(x: np.ndarray) -> bool:
    """Whether no sum of squares in the transformed space leaves 64 bits."""
    m = 1 << max(0, x.shape[-1] - 1).bit_length()
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return 4 * m**3 * most**2 < 2**62


def _rows(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Lists of whole numbers as an array (rows, parts, width); short ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = np.asarray(column.flatten())
    out = np.zeros((len(lengths), parts * width), np.int64)
    out[np.arange(parts * width) < lengths[:, None]] = values
    return out.reshape(len(lengths), parts, width)


def _encoded(rows: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(entry per row and part, squared distances added over the parts)."""
    found = [nearest(rows[:, p], book) for p, book in enumerate(books)]
    wide = any(d.dtype == object for _, d in found) or any(len(d) and int(d.max()) >= 2**58 for _, d in found)
    errors = sum(d.astype(object) if wide else d for _, d in found)
    return np.column_stack([i for i, _ in found]), errors


def _summed(rows: np.ndarray, index: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums per entry and component, counts per entry) of the rows of one part position."""
    counts = np.bincount(index, minlength=entries)
    most = max(abs(int(rows.max())), abs(int(rows.min())))
    exact = rows if most * len(rows) < 2**62 else rows.astype(object)
    sums = np.zeros((entries, rows.shape[1]), object)
    for e in np.flatnonzero(counts):
        sums[e] = exact[index == e].sum(axis=0)
    return sums, counts


def _collector(books: list[np.ndarray], width: int):
    """x to (cell, sum, count) per entry and component of what the task has seen."""
    parts, entries = len(books), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            rows = _rows(batch.column("x"), parts, width)
            if len(rows):
                index, _ = _encoded(rows, books)
                for p in range(parts):
                    more = _summed(rows[:, p], index[:, p], entries)
                    sums[p], counts[p] = sums[p] + more[0], counts[p] + more[1]
        used = np.flatnonzero(np.repeat(counts.ravel(), width))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int64()),
                pa.array([int(s) for s in sums.ravel()[used]], pa.decimal128(38, 0)),
                pa.array(np.repeat(counts.ravel(), width)[used], pa.int64()),
            ],
            names=["cell", "s", "n"],
        )

    return run


def _coder(books: list[np.ndarray], width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column("x"), len(books), width)
            index, errors = _encoded(rows, books) if len(rows) else (np.zeros((0, len(books)), int), [])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(index.tolist(), pa.list_(pa.int32())),
                    pa.array([min(LONG, int(e)) for e in errors], pa.int64()),
                ],
                names=[*names, "code", "error"],
            )

    return run


def product_codes(
    vectors: DataFrame,
    settings: Settings = Settings(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, the columns in ``keep``, ``code`` (entry per part) and ``error`` per usable row; final codebooks per part).

    Rows whose vector is null or holds a null or non-finite component are left
    out. Codebooks start from the rows with the least ids; null ids come last,
    rows of one id by their vectors. With fewer rows than entries the codebooks
    are as short. Vectors of different lengths, or of one that the parts don't
    divide, are filled up with zeros at their end. Components and errors beyond
    a long stop at its end. Without a usable row there are no codebooks.
    """
    s, names = settings, [id_column, *keep]
    whole = vectors.select(*names, whole_components(F.col(vector_column), s.scale).alias("x")).where("x is not null")
    rows = stored(whole, "codes-whole")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    out = schema(rows, names, "code array<int>, error long")
    if longest is None:
        return rows.sparkSession.createDataFrame([], out), []
    width = max(1, -(-longest // s.parts))
    first = rows.orderBy(F.col(id_column).asc_nulls_last(), "x").limit(s.entries).select("x").collect()
    start = _rows(pa.array([r.x for r in first], pa.list_(pa.int64())), s.parts, width)
    books = [start[:, p].copy() for p in range(s.parts)]
    for _ in range(s.rounds):
        sums = rows.select("x").mapInArrow(_collector(books, width), "cell long, s decimal(38,0), n long")
        for r in sums.groupBy("cell").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect():
            (p, e), i = divmod(r.cell // width, len(first)), r.cell % width
            books[p][e, i] = int(r.s) // r.n
    return rows.mapInArrow(_coder(books, width, names), out), books


def digests(vectors: DataFrame) -> DataFrame:
    coded, books = product_codes(vectors, keep=("label",))
    coded = stored(coded, "codes-coded")
    final = ",".join(str(int(x)) for book in books for x in book.ravel())
    errors = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error"))
    errors = errors.withColumnRenamed("label", "of_label")
    code = F.array_join(F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id",
        code.alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(final.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _sql(s: Settings = Settings()) -> str:
    """The rounds written out one after another."""
    steps = [
        f"""whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""cut AS MATERIALIZED (
  SELECT rid, p, x[p * (len(x) // {s.parts}) + 1 : (p + 1) * (len(x) // {s.parts})] AS x FROM whole, range({s.parts}) AS r(p)
)""",
        f"book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM cut WHERE rid <= {s.entries})",
    ]
    for i in range(s.rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT rid, p, e, d, x FROM (
    SELECT rid, cut.p, e, x, CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS BIGINT) AS d
    FROM cut JOIN book{i} USING (p)
  ) QUALIFY row_number() OVER (PARTITION BY rid, p ORDER BY d, e) = 1
)""")
        if i < s.rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(new.c, old.c) AS c FROM book{i} AS old LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS c FROM (
      SELECT p, e, i, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS m
      FROM (SELECT p, e, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM near{i}) GROUP BY p, e, i
    ) GROUP BY p, e
  ) AS new USING (p, e)
)""")
    steps.append(f"""coded AS MATERIALIZED (
  SELECT rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{s.rounds} GROUP BY rid
)""")
    steps.append(f"digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{s.rounds})")
    return (
        "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256"
        " FROM whole JOIN coded USING (rid), digest"
    )


QUERIES = {"op13_vector_codes": Query(lambda spark, sf_dir: digests(table(spark, sf_dir, "embeddings")), _sql())}
