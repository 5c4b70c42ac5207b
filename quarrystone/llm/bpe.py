"""Byte-level BPE encoding and decoding.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel.
Neighbouring chunks are stitched at a pre-token boundary that both have found in
their overlap, and the pieces between the stitches are encoded in parallel.

A boundary with a non-blank before it and white space after it holds wherever
the matching began, because no alternative of the pattern runs from a non-blank
into white space. Only such boundaries are used as stitches; chunks whose
overlap has none are encoded as one piece.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm.common import Query, rank_file, schema, slices, table, whole_text

CHUNK = 16_384
OVERLAP = 512


@functools.lru_cache(maxsize=2)
def _encoding(vocabulary: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_file(vocabulary), special_tokens={}
    )


@functools.lru_cache(maxsize=1)
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


@functools.lru_cache(maxsize=2)
def _byte_strings(vocabulary: str) -> list[bytes]:
    ranks = rank_file(vocabulary)
    out = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        out[rank] = piece
    return out


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Token ids of every text, as an ordinary-text encoder with this vocabulary gives them.

    Returns one row per row of ``docs`` with the id column, ``n_tokens`` (long)
    and ``ids`` (array of int). A null or empty text has no ids. Repeated rows
    and null ids each get their row. Other columns of ``docs`` are not read.
    """
    short, long = _by_length(docs, vocabulary, id_column, chunk, overlap)
    both = short.mapInArrow(_encoder(vocabulary), schema(short, ["id"], "ids array<int>")).unionByName(long)
    return both.select(F.col("id").alias(id_column), F.size("ids").cast("long").alias("n_tokens"), "ids")


def _by_length(docs: DataFrame, vocabulary: str, id_column: str, chunk: int, overlap: int) -> tuple[DataFrame, DataFrame]:
    """((id, text) of texts of one chunk at most, (id, ids) of longer ones)."""
    if not 0 < overlap < chunk:
        raise ValueError("overlap must be positive and smaller than chunk")
    texts = docs.select(F.col(id_column).alias("id"), whole_text().alias("text"))
    is_long = F.length("text") > chunk

    # Rows with equal id and text share a key; their pieces are equal and meet in a set.
    keyed = texts.where(is_long).withColumn("key", F.xxhash64("text", "id"))
    cut = keyed.select("id", "key", "text").mapInArrow(
        _cutter(chunk, overlap), schema(keyed, ["id", "key"], "k int, text string")
    )
    chunks = cut.repartition("key", "k")
    ends = chunks.mapInArrow(
        _boundary_finder(chunk, overlap),
        "key long, k int, head array<int>, tail array<int>",
    ).groupBy("key", "k").agg(F.first("head").alias("head"), F.first("tail").alias("tail"))
    order = Window.partitionBy("key").orderBy("k")
    stitched = (
        ends.withColumn("lo", F.array_min(F.array_intersect("head", F.lag("tail").over(order))))
        .withColumn("hi", F.lead("lo").over(order))
        .withColumn("run", F.sum(F.when(F.col("lo").isNull(), 0).otherwise(1)).over(order))
        .withColumn("joined", F.count("*").over(Window.partitionBy("key", "run")) > 1)
        .withColumn("last", F.lead("k").over(order).isNull())
        .select("key", "k", "run", "joined", "lo", "hi", "last")
    )
    # Offsets are chunk-relative: head boundaries as they are, the next chunk's `lo` lies one step further on.
    step = chunk - overlap
    start = F.coalesce(F.col("lo"), F.lit(0))
    stop = F.when(F.col("last"), F.length("text")).otherwise(F.coalesce(F.col("hi"), F.lit(0)) + step)
    pieces = chunks.join(stitched, ["key", "k"]).select(
        "id", "key", "run", "joined", "k", F.substring("text", start + 1, stop - start).alias("text")
    )
    ordered = F.sort_array(F.collect_set(F.struct("k", "text")))
    merged = (
        pieces.where("joined")
        .groupBy("id", "key", "run")
        .agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text"))
    )
    whole_pieces = pieces.where("not joined").select("id", "key", "run", "text").unionByName(merged)
    encoded = whole_pieces.mapInArrow(
        _encoder(vocabulary), schema(keyed, ["id", "key"], "run long, ids array<int>")
    )
    per_key = encoded.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("run", "ids"))).alias("runs"))
    per_key = per_key.select("id", "key", F.flatten(F.transform("runs", lambda x: x["ids"])).alias("ids"))
    rows = keyed.groupBy(F.col("id").alias("row_id"), F.col("key").alias("row_key")).count()
    long = (
        rows.join(per_key, F.col("row_key").eqNullSafe(F.col("key")) & F.col("row_id").eqNullSafe(F.col("id")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
        .select("id", "ids")
    )
    return texts.where(~is_long), long


def decode(encoded: DataFrame, vocabulary: str, ids_column: str = "ids") -> DataFrame:
    """Adds ``bytes`` (binary): the concatenated byte strings of the ids; empty for no ids, null for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = _byte_strings(vocabulary)
        for batch in slices(batches, ids_column):
            ids = batch.column(ids_column)
            out = [None if row is None else b"".join([strings[i] for i in row]) for row in _lists(ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "bytes"]
            )

    return encoded.mapInArrow(run, schema(encoded, encoded.columns, "bytes binary"))


def _lists(column: pa.Array) -> Iterator[list[int] | None]:
    """Rows of a list column, one after another."""
    offsets, values, valid = column.offsets.to_numpy(), column.values.to_numpy(), column.is_valid()
    for i, ok in enumerate(valid.to_pylist()):
        yield values[offsets[i] : offsets[i + 1]].tolist() if ok else None


def _encoder(vocabulary: str):
    """Replaces the column ``text`` by ``ids``; other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in slices(batches, "text"):
            at = batch.schema.get_field_index("text")
            ids = pa.array([encoding.encode_ordinary(t.as_py()) for t in batch.column(at)], pa.list_(pa.int32()))
            kept = [(n, c) for i, (n, c) in enumerate(zip(batch.schema.names, batch.columns)) if i != at]
            yield pa.RecordBatch.from_arrays([*(c for _, c in kept), ids], names=[*(n for n, _ in kept), "ids"])

    return run


def _cutter(chunk: int, overlap: int):
    """(id, key, text) to (id, key, k, chunk text); every chunk but the last has the full length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = chunk - overlap
        for batch in slices(batches, "text"):
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                starts = range(0, max(len(text) - overlap, 1), step)
                parts = pa.array([text[s : s + chunk] for s in starts], pa.string())
                row = pa.array([i] * len(parts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(range(len(parts)), pa.int32()), parts],
                    names=["id", "key", "k", "text"],
                )

    return run


def _boundary_finder(chunk: int, overlap: int):
    """Per chunk its stitchable boundaries: those in its first ``overlap`` characters as offsets in this
    chunk, and those in its last ones as offsets in the next chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, step = _pattern(), chunk - overlap
        for batch in slices(batches, "text"):
            heads, tails = [], []
            for value in batch.column("text"):
                text = value.as_py()
                found = [
                    p
                    for p in (m.end() for m in pattern.finditer(text))
                    if p < len(text) and text[p].isspace() and not text[p - 1].isspace()
                ]
                heads.append([p for p in found if p < overlap])
                tails.append([p - step for p in found if p > step])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("k"), *(pa.array(x, pa.list_(pa.int32())) for x in (heads, tails))],
                names=["key", "k", "head", "tail"],
            )

    return run


def _digester(vocabulary: str, given: str):
    """(id, text or ids) to the number of tokens and the digests of the ids and of the decoded bytes.

    Encoding, decoding and digests are one function, so that a task has one
    Python worker and neither ids nor bytes go back to the JVM.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        strings, encode = _byte_strings(vocabulary), _encoding(vocabulary).encode_ordinary
        names = [str(i) for i in range(len(strings))]
        for batch in slices(batches, given, 1 << 19):
            counts, of_ids, of_bytes = [], [], []
            for ids in _lists(batch.column("ids")) if given == "ids" else map(encode, batch.column("text").to_pylist()):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(b"".join([strings[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digests(docs: DataFrame, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encodes, decodes and digests: doc_id, n_tokens, ids_sha256 and decoded_sha256; rows as in ``encode``."""
    out = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    short, long = _by_length(docs, vocabulary, "doc_id", chunk, overlap)
    whole = short.mapInArrow(_digester(vocabulary, "text"), schema(short, ["id"], out))
    return whole.unionByName(long.mapInArrow(_digester(vocabulary, "ids"), schema(long, ["id"], out))).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_byte_bpe": Query(lambda spark, sf_dir: digests(table(spark, sf_dir, "documents"), default_vocabulary())),
}
