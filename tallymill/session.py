"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tallymill", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and UTC timestamps."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send rows to Python ``rows`` at a time from now on.

    For rows that hold whole texts: the buffers of a batch are kept on both sides of every
    task, and ten thousand long texts are many megabytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables; every executor can reach it.

    It lies below ``spark.checkpoint.dir``, or below the session's warehouse folder where
    that is unset, whatever the master is. Its file system deletes it when the
    application ends, so results that still read from it stay valid until then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    )
    root = f"{base.rstrip('/')}/tallymill-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` and the tree trainers cut lineage reliably."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the scratch folder once and read it back.

    For a costly frame that one plan reads several times: the work is done once, the
    lineage ends at the files, and a lost executor loses none of it. ``by`` lays the
    files out in one folder per value, so that a reader of one value opens only those.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
