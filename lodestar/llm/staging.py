"""Tables written in the shared folder named by ``spark.checkpoint.dir``.

An operator that reads the same intermediate rows more than once writes them
there and reads them back: the lineage is cut, and a lost executor costs only
the tasks it was running. A staged table is dropped as soon as its last reader
is written (``release``), or when the Python driver ends if the query's lazy
result reads it."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The shared folder. Only a local master may run without the setting
    (tests); a cluster session without it is refused."""
    path = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if not path:
        # executors of local-cluster[...] are processes of their own
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_KEY} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="lodestar-llm-")
        spark.conf.set(_KEY, path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the table that reads it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def stage_lean(df: DataFrame, name: str) -> DataFrame:
    """``stage`` for a long chain of tables: Spark drops the shuffle files of
    the write as it ends, instead of some time after nothing refers to its
    plan (the last plan stays referred to until another query begins)."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(_CLEANUP, before)


def release(*tables: DataFrame) -> None:
    """Drop staged tables that nothing reads any more."""
    for table in tables:
        _written.remove((table.sparkSession, table._staged))
        _delete(table.sparkSession, table._staged)
    if tables:
        drop_shuffles(tables[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of steps that are written: it does so
    when the driver's JVM collects their plans, else only every
    ``spark.cleaner.periodicGC.interval``."""
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: its files are left to the cluster's own cleaning
            return
