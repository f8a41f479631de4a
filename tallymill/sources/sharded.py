"""A family of daily tables kept as one dataset partitioned by its date suffix."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.session import scratch_root

SUFFIX = "suffix"


def write_sharded(df: DataFrame, path: str, day: Column, mode: str = "errorifexists") -> None:
    """Write ``df`` partitioned by ``yyyyMMdd`` of ``day``.

    No repartition by suffix: one busy day would end up in one task. Each task
    writes its own file per day it holds.
    """
    (
        df.withColumn(SUFFIX, F.date_format(day, "yyyyMMdd"))
        .write.mode(mode)
        .partitionBy(SUFFIX)
        .parquet(path)
    )


def daily_tables(spark: SparkSession, source: str, day: Column) -> str:
    """The path of the parquet table ``source`` as daily tables, written once per application.

    The folder is named by the source's path and the state of its files, so every query of
    an unchanged table opens the same daily tables, and a changed one is laid out anew.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = files.getContentSummary(path)
    state = f"{source} {files.getFileStatus(path).getModificationTime()} {summary.getLength()} {summary.getFileCount()}"
    target = f"{scratch_root(spark)}/daily-{hashlib.md5(state.encode()).hexdigest()}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        write_sharded(spark.read.parquet(source), target, day, "overwrite")
    return target


def read_sharded(spark: SparkSession, path: str, lo: str, hi: str) -> DataFrame:
    """Rows of the daily tables ``lo``..``hi`` (both included), pruned to those folders."""
    df = spark.read.option("basePath", path).parquet(path)
    # The folder names read back as integers when type inference is on.
    kind = df.schema[SUFFIX].dataType
    pruned = df.where(F.col(SUFFIX).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))
    return pruned.withColumn(SUFFIX, F.col(SUFFIX).cast("string"))
