"""Sinks: appends, full replacements, partition rebuilds, the reject table and reconciliation with files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.relational import insert_ignore


def append(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partitions).parquet(path)


def replace(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """A full rebuild of the table. df must not read from the path."""
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Only the partitions that df has rows of are rebuilt, for example one year."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def rebuild_partitions(df: DataFrame, path: str, column: str, values: Sequence[int]) -> None:
    """The partitions of the given values hold the rows that df has of them, and are gone where it has none; others stay untouched.

    df must not read from the path. Repeating the call gives the same table.
    """
    spark = df.sparkSession
    replace_partitions(df.filter(F.col(column).isin(list(values))), path, [column])
    files = Folder(spark, path)
    for value in set(values) - {r[0] for r in df.select(column).filter(F.col(column).isin(list(values))).distinct().collect()}:  # at most the values
        files.remove(f"{column}={value}")


class Folder:
    """A folder of a file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path, self._type = path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._type(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def has(self, name: str = "") -> bool:
        return self._files.exists(self._type(f"{self._path}/{name}" if name else self._path))

    def remove(self, name: str) -> None:
        self._files.delete(self._type(f"{self._path}/{name}"), True)


def append_missing(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], order: str) -> None:
    """Appends the rows whose key the table lacks (the first by order), without rewriting what is there."""
    table = spark.read.parquet(path)
    insert_ignore(table.limit(0), df.join(table.select(*keys), list(keys), "left_anti"), keys, order).write.mode("append").parquet(path)


def stamped(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    """df with the time of its load, the same for all its rows."""
    return df.withColumn(column, F.current_timestamp())


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a country code, rows to keep as bad locations)."""
    return df.filter("country_code is not null"), df.filter("country_code is null")


def reconcile(files: DataFrame, table: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(files that the table doesn't know, rows of the table whose file is gone)."""
    return files.join(table.select(*keys), list(keys), "left_anti"), table.join(files.select(*keys), list(keys), "left_anti")


def copy_tables(spark: SparkSession, names: Sequence[str], source: str, target: str) -> None:
    for name in names:
        replace(spark.read.parquet(f"{source}/{name}"), f"{target}/{name}")


def set_state(spark: SparkSession, path: str, **values: str) -> None:
    """Keeps key-value state: one row a key, the new values over the old ones. The state is a handful of rows."""
    old = get_state(spark, path)
    rows = sorted((old | {k: str(v) for k, v in values.items()}).items())
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("overwrite").parquet(path)


def get_state(spark: SparkSession, path: str) -> dict[str, str]:
    if not Folder(spark, path).has():
        return {}
    return {r.key: r.value for r in spark.read.parquet(path).select(F.col("key"), F.col("value")).collect()}
