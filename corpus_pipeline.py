"""A training corpus from raw documents: toxic texts out, near copies out, secrets masked, sources mixed, texts encoded.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes every stage's
result to the shared scratch folder and reads it back for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarrystone.llm import bpe, dedup, mixing, secrets, toxicity
from quarrystone.llm.common import Query, bounded_batches, drop_scratch, fold, scratch_paths, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR = dedup.Settings(width=5, percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the classifier learns from labels of the folds for learning."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold(4) != 2))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def _row_key() -> tuple[Column, Column]:
    """Two hashes over all columns of a row: rows with one key are equal and may stand for each other."""
    return F.xxhash64(*COLUMNS).alias("k1"), F.xxhash64(*reversed(COLUMNS), F.lit(1)).alias("k2")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: the one with the least id (null last), equal ids by their row keys.

    Rows without words have no group and all stay.
    """
    rows = docs.select(*COLUMNS, *_row_key())
    named = rows.withColumnsRenamed({"k1": "r1", "k2": "r2"})
    groups = dedup.near_duplicates(named, NEAR, keep=("r1", "r2"))
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", F.col("r1").alias("k1"), F.col("r2").alias("k2"))
    one = groups.where("component is not null").groupBy("component").agg(F.min(order).alias("first")).select("first.k1", "first.k2")
    chosen = rows.join(one, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    wordless = rows.where(mixing.word_count(mixing.whole_text()) == 0)
    return chosen.select(*COLUMNS).unionByName(wordless.select(*COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their secrets replaced by a mark, and n_chars of the new text."""
    masked = secrets.redact(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice, a part of one counting as the whole."""
    rows = docs.select(*COLUMNS, F.struct(*_row_key()).alias("key"), mixing.word_count(mixing.whole_text()).alias("size"))
    sized = stored(rows.select("key", "source", "size"), "mix-sizes")
    taken = mixing.mix(sized, id_column="key").documents
    times = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    per_key = taken.groupBy("key").agg(F.sum(times).alias("times"), F.count("*").alias("rows")).where("times > 0")
    # Equal rows share what they take: the first ones by number get one more.
    nth = F.row_number().over(Window.partitionBy("key").orderBy("size"))
    joined = rows.join(per_key, "key").withColumn("nth", nth)
    copies = F.expr("times div rows + if(nth <= times % rows, 1, 0)").cast("int")
    repeated = joined.withColumn("copies", copies).where("copies > 0")
    return repeated.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests of the ids and of the decoded bytes of every document of the mix."""
    return bpe.digests(docs, bpe.default_vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    return lambda spark, docs, sf_dir: stage(bounded_batches(spark), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _bounded(drop_toxic)),
    ("near copies", _bounded(drop_near_copies)),
    ("secrets", _bounded(mask_secrets)),
    ("mixing", _bounded(mix_sources)),
    ("byte BPE", _bounded(encode)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has left in the scratch folder goes when the next one's rows are stored."""
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with scratch_paths() as made:
            docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        drop_scratch(spark, [*before, *made[:-1]])
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained models, compression and tokenisation are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None

QUERY = Query(run, ORACLE_SQL)
