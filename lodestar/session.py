"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lodestar", driver_memory: str = "16g") -> SparkSession:
    """A session tuned for these jobs: AQE on (coalesce + skew join), UI off,
    UTC session time zone. ``master`` is only applied when given (tests and
    bench); on a cluster the launcher decides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        # local mode: the driver JVM is the only executor, give it the heap
        builder = builder.master(master).config("spark.driver.memory", driver_memory)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    # Shuffle width: local runs use the core count; on a cluster the
    # deployment's setting stays (sized for the data), and AQE coalesces
    # small partitions at run time.
    if shuffle_partitions or master:
        builder = builder.config("spark.sql.shuffle.partitions",
                                 str(shuffle_partitions or os.cpu_count() or 8))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master may run without the setting (tests, bench); it gets a
    scratch folder of its own. A cluster session without it is refused."""
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not configured:
        # executors of local-cluster[...] are processes of their own
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, configured)
    return configured.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, dropped when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used by the iterative jobs (crawl levels, tree levels, shared
    intermediate tables): the plan does not grow with the number of
    iterations, each level is computed once, a lost executor costs only the
    tasks it was running, and nothing stays cached. The tables are dropped
    when the Python driver ends; a lazy result may read them until then."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, stats=()):
    """``cut_lineage`` with the row count (and, when ``stats`` aggregate
    Columns are given, a Row of those aggregates): ``(df, n[, row])``."""
    out = cut_lineage(df)
    row = out.agg(F.count(F.lit(1)).alias("_n"), *stats).first()
    return (out, row["_n"], row) if stats else (out, row["_n"])


def first_by(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` smallest rows by ``order``, for any ``n``: rows are dealt
    into ranges, whole ranges are kept up to the one that holds the n-th row,
    and only that one is ranked. The driver reads one count per range."""
    dealt = cut_lineage(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    kept, left = [], n
    for r in sorted(dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("c")).collect(), key=lambda r: r["_range"]):
        if r["c"] > left:
            last = dealt.where(F.col("_range") == r["_range"])
            last = last.withColumn("_i", F.row_number().over(Window.partitionBy("_range").orderBy(order)))
            return (dealt.where(F.col("_range").isin(kept)) if kept else dealt.where(F.lit(False))).unionByName(
                last.where(F.col("_i") <= left).drop("_i")).drop("_range")
        kept.append(r["_range"])
        left -= r["c"]
    return dealt.drop("_range")


@atexit.register
def _drop_written() -> None:
    for spark, path in _written:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended: its files are left to the cluster's own cleaning
            return
