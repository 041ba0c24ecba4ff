"""Name -> query and oracle SQL of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textsignal.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Source:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``fn(source)``."""

    def wrap(fn: Callable[[Source], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
