"""Mixing sources to target weights with a low-discrepancy schedule.

Golden-ratio points mapped through the cumulative targets say which source each
slot of the mix takes from; slots are ranked per source, and the k-th slot of a
source takes the k-th block of its shuffled documents, around and around. Blocks
hold equally many words and may cut documents.

A source may hold a third of all documents or slots: ranks and running sums are
built from counts per source and bucket, so that no task sees a whole source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm.common import Query, stored, table, whole_text, word_count

SHARE = 1.5
CAP = 2.0
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 1_000
GOLDEN = 0.6180339887498949
BUCKET_ROWS = 8_192


@dataclass(frozen=True)
class Mix:
    """A mix: where each document's words lie, what each source gives, and which slot takes which block."""

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame


def source_targets(sized: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, ix, source_size, target) from (source, size): weights repeat over the sources by code point, null last.

    The level is found by rounds over the table of sources: what lies above its
    cap is held there, and the rest is shared anew until nothing is above.
    """
    spark = sized.sparkSession
    by_source = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    order = [F.col("source").asc_nulls_last()]
    cut = stored(
        by_source.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()),
        "mix-order",
    )
    # Row numbers over all sources without one task holding them: the part in the high bits, its offset from counts per part.
    part, inner = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    parts = cut.groupBy(part.alias("part")).count()
    offsets = parts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("offset"))
    numbered = cut.withColumn("part", part).join(offsets, "part").withColumn("ix", F.col("offset") + inner)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("ix") % len(weights)).cast("int") + 1).cast("double")
    weighed = stored(numbered.select("source", "ix", "source_size", weight.alias("w")), "mix-weights")
    ceiling = cap * F.col("source_size")
    level, total = 0.0, None
    while True:
        held = ceiling <= level * F.col("w")
        row = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(held, ceiling).otherwise(0.0)).alias("held"),
            F.sum(F.when(held, 0.0).otherwise(F.col("w"))).alias("free"),
        ).first()
        total = share * float(row["all"] or 0)
        if not row["free"]:
            break
        new = (total - row["held"]) / row["free"]
        if new <= level:
            break
        level = new
    return weighed.select(
        "source", "ix", "source_size", F.least(ceiling, level * F.col("w")).cast("double").alias("target")
    )


def _running(frame: DataFrame, value: str, keys: list[str], bucket: str, order: list) -> Column:
    """Sum of ``value`` before each row, by keys in the order of (bucket, order), from sums per bucket."""
    sums = frame.groupBy(*keys, bucket).agg(F.sum(value).alias("in_bucket"))
    before = sums.select(
        *(F.col(k).alias(f"_{k}") for k in [*keys, bucket]),
        (F.sum("in_bucket").over(Window.partitionBy(*keys).orderBy(bucket)) - F.col("in_bucket")).alias("_before"),
    )
    near = Window.partitionBy(*keys, bucket).orderBy(*order)
    placed = frame.withColumn("_n", F.row_number().over(near)).withColumn(
        "_inner", F.sum(value).over(near.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)
    )
    on = [placed[k].eqNullSafe(before[f"_{k}"]) for k in [*keys, bucket]]
    joined = placed.join(before, on).withColumn("start", F.col("_inner") + F.col("_before"))
    return joined.drop(*(f"_{k}" for k in [*keys, bucket]), "_inner", "_before")


def mix(
    sized: DataFrame,
    id_column: str = "doc_id",
    share: float = SHARE,
    cap: float = CAP,
    weights: tuple[int, ...] = WEIGHTS,
    block: int = BLOCK_WORDS,
    seed: int = 17,
) -> Mix:
    """A mix of documents given as (id, source, size in words).

    Every source gives its target, rounded down, exactly: what the schedule
    deals beyond it is left out and what is missing follows at the end. No
    document gives more than ``cap`` times its size. Sources and documents
    without words give nothing. Reruns agree; repeated rows are separate
    documents, and which of two equal rows comes first makes no difference.

    ``documents``: id, source, size, source_size, target, taken. ``slots``: slot,
    source index, block, words.
    """
    spark = sized.sparkSession
    rows = sized.select(F.col(id_column).alias("id"), "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    targets = stored(source_targets(rows, share, cap, weights), "mix-targets")
    counts = rows.agg(F.count("*").alias("rows")).first()
    buckets = max(64, -(-counts["rows"] // BUCKET_ROWS))

    known = targets.withColumnRenamed("source", "_source")
    placed = rows.join(known, rows.source.eqNullSafe(known["_source"])).drop("_source")
    placed = placed.withColumn("h", F.xxhash64("id", "size", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    line = _running(placed, "size", ["ix"], "bucket", ["h", "id"])

    # A document's words in blocks; without words it stays as one row that no slot meets.
    size = F.col("size")
    cover = F.explode_outer(
        F.when(size > 0, F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}")))
    )
    pieces = line.withColumn("block", cover)

    slots = schedule(spark, targets, block)
    quota = F.floor("target").cast("long")
    taken = slots.join(targets.select(F.col("ix").alias("_ix"), "source_size", quota.alias("quota")), F.col("ix") == F.col("_ix"))
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    begin = F.expr("turn * source_size") + F.col("block") * block
    length = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    taken = (
        taken.withColumn("turn", F.expr(f"rank div ((source_size + {block - 1}) div {block})"))
        .withColumn("block", F.col("rank") % blocks)
        .withColumn("words", F.greatest(F.lit(0), F.least(length, F.col("quota") - begin)))
        .where("words > 0")
        .select("slot", "ix", "block", "words")
    )
    reached = taken.select(F.col("ix").alias("_ix"), F.col("block").alias("_block"), "words")
    met = pieces.join(reached, (F.col("ix") == F.col("_ix")) & (F.col("block") == F.col("_block")), "left")
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(F.col("start") + size, F.col("block") * block + F.coalesce("words", F.lit(0)))
    documents = (
        met.groupBy("id", "source", "size", "source_size", "target", "ix", "bucket", "_n")
        .agg(F.sum(F.greatest(F.lit(0), F.coalesce(high - low, F.lit(0)))).cast("long").alias("taken"))
        .select(F.col("id").alias(id_column), "source", "size", "source_size", "target", "taken")
    )
    return Mix(documents, targets, taken)


def schedule(spark: SparkSession, targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, ix, rank): golden-ratio points through the cumulative targets, ranked per source, as many as each needs.

    The interval of the points is cut into cells, so that points find their
    source by an equality join however wide it is.
    """
    whole = F.col("source_size")
    quota = F.floor("target").cast("long")
    rest = quota - F.floor(quota / F.greatest(whole, F.lit(1))) * whole
    blocks = lambda words: F.ceil(words / F.lit(block)).cast("long")
    need = F.when(whole > 0, F.floor(quota / whole) * blocks(whole) + blocks(rest)).otherwise(0).cast("long")
    needed = stored(targets.select("ix", need.alias("need")).where("need > 0"), "mix-needed")
    facts = needed.agg(F.count("*").alias("n"), F.sum("need").alias("slots")).first()
    slots, cells = int(facts["slots"] or 0), 4 * int(facts["n"]) or 1

    step = BUCKET_ROWS
    # Cumulative shares over the sources, from sums per bucket of sources.
    shares = _running(needed.withColumn("bucket", F.expr(f"ix div {step}")).withColumn("one", F.lit(0)), "need", ["one"], "bucket", ["ix"])
    total = F.lit(float(max(slots, 1)))
    edges = shares.select("ix", "need", (F.col("start") / total).alias("a"), ((F.col("start") + F.col("need")) / total).alias("z"))
    last = F.least(F.floor(F.col("z") * cells), F.lit(cells - 1))
    edges = edges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a") * cells), last)))

    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1.0).alias("x"))
    points = points.withColumn("cell", F.floor(F.col("x") * cells))
    dealt = points.join(edges, "cell").where("x >= a and x < z").select("slot", "ix", "need")
    dealt = dealt.withColumn("bucket", F.expr(f"slot div {step}")).withColumn("one", F.lit(1))
    ranked = _running(dealt, "one", ["ix"], "bucket", ["slot"]).withColumnRenamed("start", "rank").where("rank < need")
    ranked = ranked.select("slot", "ix", "rank")
    had = ranked.groupBy(F.col("ix").alias("_ix")).agg(F.count("*").alias("had"))
    missing = (
        needed.join(had, F.col("ix") == F.col("_ix"), "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < need")
        .select("ix", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("rank"))
    )
    return ranked.unionByName(missing.select((F.col("rank") + slots).alias("slot"), "ix", "rank"))


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of every whole text; the texts go no further."""
    return docs.select("doc_id", "source", word_count(whole_text()).alias("size"))


def mixed_sizes(docs: DataFrame) -> DataFrame:
    sized = stored(sizes(docs), "mix-sizes")
    return mix(sized).documents.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op7_mixing": Query(lambda spark, sf_dir: mixed_sizes(table(spark, sf_dir, "documents")))}
