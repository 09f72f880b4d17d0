"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: An Arrow batch that goes to a Python worker holds so many bytes unless the session sets its own: a batch is held several times
#: over, on both sides. Rows alone don't bound it, since texts may be long.
BATCH_BYTES, SPARK_BATCH_BYTES = 4 << 20, 64 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once for each application, so that table functions find them there, and bounds
    the bytes of an Arrow batch: for the whole session from then on, unless the session has set its own.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if re.sub(r"\D", "", spark.conf.get(setting, f"{SPARK_BATCH_BYTES}b")) == str(SPARK_BATCH_BYTES):
        spark.conf.set(setting, f"{BATCH_BYTES}b")
    sc = spark.sparkContext
    if getattr(sc, "_corvane_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="corvane-code-"), "corvane_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    sc._corvane_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors see.

    It's the one that the cluster names in spark.checkpoint.dir. Where that is unset, a local master gets a folder under the
    machine's temporary one, since driver and executor are one process there; any other master gets one in the warehouse.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        found = sc._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if base is None:
        if sc.master.split("[")[0] == "local":
            base = f"file://{tempfile.mkdtemp(prefix='corvane-')}"
        else:
            base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_corvane_work"
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's own part of the shared folder, which the file system removes when the application ends."""
    sc = spark.sparkContext
    root = getattr(sc, "_corvane_root", None)
    if root is None:
        root = f"{shared_dir(spark)}/corvane-{uuid.uuid4().hex}"
        target = sc._jvm.org.apache.hadoop.fs.Path(root)
        files = target.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(target)
        files.deleteOnExit(target)
        sc._corvane_root = root
    return f"{root}/{name}-{uuid.uuid4().hex}"


#: Rows of one file, where the number of rows is known.
FILE_ROWS = 500_000


def written(df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
    """The rows of df after they were written to the shared folder: lineage ends there, and lost executors cost nothing.

    most_rows, where the caller knows a bound, keeps a small table from becoming as many files as a shuffle has partitions.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // FILE_ROWS)))
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corvane_path = path
    return out


#: Tasks a core among which spread() deals rows.
TASKS_PER_CORE = 3


def spread(df: DataFrame, key: str) -> DataFrame:
    """df dealt to tasks by a key, before work that takes long for each row.

    Spark cuts a table by its bytes: a file of some megabytes is one task, however many rows it holds and however long they take.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, key)


def removed(df: DataFrame) -> None:
    """Deletes a table that written() made and that nothing reads any more."""
    path = getattr(df, "_corvane_path", None)
    if path is not None:
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
