"""Intermediate tables of iterative plans, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a single-process session may leave it unset: it gets one of its own.

    On a cluster a folder of the driver's machine would not be seen by the executors, so there this is an error.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{SETTING} must name a folder that driver and executors share (master: {master})")
        base = "file://" + tempfile.mkdtemp(prefix="runnel-")
        spark.conf.set(SETTING, base)
    return base.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/runnel/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table or folder that no plan will read again."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once its results are written."""
    discard(spark, _own_dir(spark))


def materialize(df: DataFrame, name: str, path: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet, with the writer's ``options``, into the shared folder (to ``path`` if given) and read it back.

    This cuts the lineage by a table every executor can read, so that losing executors
    loses nothing and later stages do not repeat the work.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
