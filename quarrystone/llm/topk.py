"""Exact top-k search by inner product with vector-approximation files.

Every vector is stored a second time in one byte per component: with a shift of
its own, so that its components fit. A component x of cell c and shift s lies in
c * 2^s ... c * 2^s + 2^s - 1, so one product of a query with the cells bounds
its score from both sides. The cells are scanned in blocks for groups of
queries; the k-th best lower bound over all blocks is what a query is certain
of, and only vectors whose upper bound reaches it remain. Exact vectors are then
read for these alone, in falling order of their upper bounds: first as many as
are asked for, then those that may still beat the k-th exact score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm.common import Query, schema, stored, table

BLOCK_ROWS = 16_384
GROUP_QUERIES = 4_096
# Queries whose bounds over a block are held at once.
STEP = 128
LONG = 2**63 - 1


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) per component; null where the vector or a component is null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(scale * x.cast("double"))))


def _lists(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(whole.flatten()).reshape(len(whole), -1)


def approximate(rows: DataFrame) -> DataFrame:
    """(row, id, dims, x) to (row, id, dims, shift, cells): one byte per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifts, cells = [], []
            for x in batch.column("x"):
                x = x.values.to_numpy()
                # floor(x / 2^s) is within -128 .. 127 from this many bits on.
                most = max(int(x.max()), -int(x.min()) - 1)
                shifts.append(max(0, most.bit_length() - 7))
                cells.append((x >> shifts[-1]).astype(np.int8).tobytes())
            kept = [batch.column(c) for c in ("row", "id", "dims")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(shifts, pa.int32()), pa.array(cells, pa.binary())], names=["row", "id", "dims", "shift", "cells"]
            )

    return rows.select("row", "id", "dims", "x").mapInArrow(run, schema(rows, ["row", "id", "dims"], "shift int, cells binary"))


def bounds(cells: np.ndarray, shifts: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of every query (rows) with every approximated vector (columns)."""
    wide = float(np.abs(queries.astype(np.float64)).max(initial=0)) * 2.0 ** (7 + int(shifts.max(initial=0))) * (2 * cells.shape[1]) >= 2.0**52
    kind = object if wide else np.float64
    width = np.array([2 ** int(s) for s in shifts], kind)
    asked = queries.astype(kind)
    middle = (asked @ cells.T.astype(kind)) * width
    up, down = np.maximum(asked, 0).sum(axis=1), np.minimum(asked, 0).sum(axis=1)
    return middle + down[:, None] * (width - 1), middle + up[:, None] * (width - 1)


def _long(values: np.ndarray) -> pa.Array:
    if values.dtype == object:
        values = np.array([max(-LONG - 1, min(LONG, int(x))) for x in values], np.int64)
    return pa.array(values.astype(np.int64))


def _scan(k: int):
    """Per group of queries and block of cells: the vectors whose upper bound reaches the query's k-th best lower one here."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            cells = np.frombuffer(b"".join(left["cells"].to_pylist()), np.int8).reshape(left.num_rows, -1)
            shifts, ids, rows = (left[c].to_numpy() for c in ("shift", "id", "row"))
            queries, own, places = _lists(right["x"]), right["id"].to_numpy(), right["row"].to_numpy()
            for start in range(0, len(queries), STEP):
                part = slice(start, start + STEP)
                least, most = bounds(cells, shifts, queries[part])
                other = ids[None, :] != own[part, None]
                for q in range(len(least)):
                    near = np.flatnonzero(other[q])
                    low, high = least[q][near], most[q][near]
                    if len(near) > k:
                        certain = sorted(low)[-k] if low.dtype == object else np.partition(low, -k)[-k]
                        open_ = high >= certain
                        near, low, high = near[open_], low[open_], high[open_]
                    found.append(
                        pa.table([pa.array(np.full(len(near), places[start + q])), pa.array(rows[near]), _long(low), _long(high)], schema=_FOUND)
                    )
        return pa.concat_tables([pa.table([[], [], [], []], schema=_FOUND), *found])

    return run


_FOUND = pa.schema([("q", pa.int64()), ("row", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])


def survivors(rows: DataFrame, k: int, block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """(q, row, high, place): per asking row the vectors that the approximation can't rule out, by falling upper bound."""
    total, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, groups = max(1, -(-total // block_rows)), max(1, -(-asking // group_queries))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    file = stored(approximate(rows), "topk-cells")
    dealt = file.select("*", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"), numbers(groups).alias("g"))
    asked = rows.where("asks").select(
        "row", "id", "dims", "x", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("g"), numbers(blocks).alias("b")
    )
    cut = ["b", "g", "dims"]
    near = dealt.groupBy(*cut).cogroup(asked.groupBy(*cut)).applyInArrow(_scan(k), "q long, row long, low long, high long")
    near = stored(near, "topk-near")
    order = Window.partitionBy("q").orderBy(F.desc("low"), "row")
    certain = near.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("q", F.col("low").alias("certain"))
    left = near.join(certain, "q", "left").where("certain is null or high >= certain")
    by_bound = Window.partitionBy("q").orderBy(F.desc("high"), "row")
    return stored(left.select("q", "row", "high", F.row_number().over(by_bound).alias("place")), "topk-left")


def _exact(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(q, row) with the asking id, the vector's id and the exact score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                small = float(np.abs(x.astype(np.float64)).max()) * float(np.abs(y.astype(np.float64)).max()) * len(x) < 2.0**62
                kind = np.int64 if small else object
                scores.append(max(-LONG - 1, min(LONG, int(x.astype(kind) @ y.astype(kind)))))
            names = ["q", "row", "query_id", "id"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores, pa.int64())], names=[*names, "score"])

    asked = rows.where("asks").select(F.col("row").alias("q"), F.col("id").alias("query_id"), F.col("x").alias("y"))
    both = pairs.select("q", "row").join(rows.select("row", "id", "x"), "row").join(asked, "q")
    return both.select("q", "row", "query_id", "id", "x", "y").mapInArrow(run, schema(both, ["q", "row", "query_id", "id"], "score long"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """The k highest inner products of every query with all rows but its own id.

    Returns query_id, rank (from 1), the id and score (long); ties go to the
    smaller id. Rows with a null id, or a vector that is null or holds a null or
    non-finite component, take no part. Only vectors of one length are compared.
    A repeated query row is a query of its own, a repeated vector a candidate of
    its own. Scores beyond the range of a long stop at its end.
    """
    whole = whole_components(F.col(vector_column))
    usable = vectors.select(F.col(id_column).alias("id"), whole.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    usable = usable.where("id is not null and x is not null and size(x) > 0").withColumn("dims", F.size("x"))
    # The numbers are stored before they are used, so they never change.
    rows = stored(usable.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    left = survivors(rows, k, block_rows, group_queries)
    first = stored(_exact(left.where(F.col("place") <= k), rows), "topk-first")
    kth = first.groupBy("q").agg(F.min("score").alias("kth"))
    open_ = left.where(F.col("place") > k).join(kth, "q").where("high >= kth")
    scored = first.unionByName(_exact(open_, rows))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

QUERIES = {
    "op9_topk": Query(lambda spark, sf_dir: top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0), SQL),
}
