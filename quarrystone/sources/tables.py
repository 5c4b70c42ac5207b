"""Writing tables, views and exports, and reading tables back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# Of stored tables; at 6 times sf0.1 a run's tables took 190 MB, 273 MB with Spark's default.
CODEC = "zstd"
# Rows of a row group of them: a scan can't be split further, and text tables pack millions of rows into few bytes.
ROW_GROUP = 500_000


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    side_by_side: Sequence[str] = (),
) -> int:
    """Replace a Parquet table and return its row count, taken while writing.

    For a partitioned table the rebalance step brings each partition's rows
    together in files of the advisory size and splits a partition that is far
    larger than the rest over several tasks. ``finish`` computes columns from
    others of the same row after that, so that they aren't shuffled. Rows alike
    in the columns ``side_by_side`` are neighbours in a task's share of that
    shuffle, which compresses them better.
    """
    seen = Observation("rows written")
    near = df.sortWithinPartitions(*side_by_side) if partition_by and side_by_side else df
    counted = near.observe(seen, F.count(F.lit(1)).alias("rows"))
    together = counted.hint("rebalance", partition_by) if partition_by else counted
    writer = (finish(together) if finish else together).write.mode("overwrite").options(**{"compression": CODEC, "parquet.block.row.count.limit": ROW_GROUP})
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return int(seen.get["rows"])


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A Parquet table; ``like`` gives its schema and column order and saves inference."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def materialize_table(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    side_by_side: Sequence[str] = (),
) -> tuple[DataFrame, int]:
    """Full refresh of a table: write it, and offer the written rows to SQL under its name."""
    rows = write_table(df, path, partition_by, finish, side_by_side)
    stored = read_table(df.sparkSession, path, like=finish(df) if finish else df)
    stored.createOrReplaceTempView(name)
    return stored, rows


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def table_exists(spark: SparkSession, name: str) -> bool:
    """True for a table or a view."""
    return spark.catalog.tableExists(name)


def _plain_text(value: Column) -> Column:
    """A double in plain decimal notation that reads back to the same double.

    The shortest text of a double is d.dddEn with one digit before the point,
    or plain already. Its digits are placed by the exponent.
    """
    text = value.cast("string")
    mantissa = F.substring_index(text, "E", 1)
    power = F.substring_index(text, "E", -1).cast("int")
    digits = F.rtrim(F.replace(F.replace(mantissa, F.lit("-"), F.lit("")), F.lit("."), F.lit("")), F.lit("0"))
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    whole = F.rpad(digits, F.greatest(power + 1, F.length(digits)), F.lit("0"))
    rest = F.substring(whole, power + 2, F.length(whole))
    large = F.concat(F.substring(whole, F.lit(1), power + 1), F.lit("."), F.when(rest == "", "0").otherwise(rest))
    plain = F.concat(sign, F.when(power < 0, small).otherwise(large))
    return F.when(F.contains(text, F.lit("E")), plain).otherwise(text)


def csv_texts(df: DataFrame) -> DataFrame:
    """The columns as they go into CSV: doubles in plain decimal notation, all else as it is.

    All doubles of a row go through one function over an array, so the code
    generated for a table doesn't grow with the number of its columns.
    """
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    if not doubles:
        return df
    texts = F.transform(F.array(*[F.col(f"`{name}`") for name in doubles]), _plain_text)
    held = "_".join(["texts", *df.columns])
    wide = df.withColumn(held, texts)
    place = {name: i for i, name in enumerate(doubles)}
    return wide.select(*[F.col(f"`{held}`")[place[n]].alias(n) if n in place else F.col(f"`{n}`") for n in df.columns])


def export_csv(df: DataFrame, path: str, **options: object) -> int:
    """Replace a folder of CSV files with header and return the row count, taken while writing.

    Options go to Spark's writer, such as the compression.
    """
    seen = Observation("rows exported")
    (
        csv_texts(df)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options)
        .csv(path)
    )
    return int(seen.get["rows"])


def export_jsonl(df: DataFrame, path: str, **options: object) -> int:
    """Replace a folder of JSON lines and return the row count, taken while writing."""
    seen = Observation("rows exported")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**options).json(path)
    return int(seen.get["rows"])


def adhoc_sql(spark: SparkSession, sql: str, args: dict | None = None, limit: int | None = None) -> DataFrame:
    """The rows of a statement over the registered tables and views; with a limit only so many are computed and sent."""
    found = spark.sql(sql, args=args)
    return found if limit is None else found.limit(limit)
