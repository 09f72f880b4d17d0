"""A register of queries, each with SQL that gives the same rows where there is such SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """tables.name is the Parquet table of that name in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str | None = None):
    """Registers f(spark, tables) under its name."""

    def add(f: Callable[[SparkSession, Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(spark, Tables(spark, folder))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add
