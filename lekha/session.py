"""Session helpers: durable intermediate tables on the shared folder of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, from ``spark.checkpoint.dir``.

    A temporary folder is made only where the setting is missing and the master is a
    single local JVM (tests); on a cluster a missing setting is an error, because a
    machine-local folder would not survive a lost executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lekha-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def _own_dir(spark: SparkSession) -> str:
    """Folder of this application, so that applications that share a folder never touch each other's tables."""
    return f"{shared_dir(spark)}/lekha/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table in the application's part of the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation, and later
    readers get column pruning. See :func:`discard` and :func:`release`.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder for files that the application writes and reads again; :func:`release` deletes it."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that no later plan reads; other frames are left alone."""
    for df in tables:
        if path := _PATHS.pop(df, None):
            _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application (call after results are stored)."""
    _delete(spark, _own_dir(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
