"""What a registered query is, and short names for its inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quarrystone.plans.registry import MODELS, derive
from workload.sample_feeds import FEEDS, sample_feed
from workload.relations import with_relations

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


def query(run: Run, sql: str | None = None) -> Query:
    return Query(run, with_relations(sql) if sql else None)


class Inputs:
    """Bundled tables, raw feeds and models of one data folder as lazy DataFrames, looked up by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = self._find(name)
        return self._memo[name]

    def _find(self, name: str) -> DataFrame:
        if name in FEEDS:
            return sample_feed(self.spark, self.sf_dir, name)
        model = next((m for m in MODELS if m.name == name), None)
        if model is not None:
            return derive(name, {i: self[i] for i in model.inputs})
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def many(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


def over(build: Callable[[Inputs], DataFrame]) -> Run:
    """A query from a function of its inputs."""
    return lambda spark, sf_dir: build(Inputs(spark, sf_dir))
