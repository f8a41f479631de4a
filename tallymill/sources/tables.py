"""Parquet tables of one folder, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymill.functions.scalars import literal_table

# The tables of the test data folder.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register_tables(spark: SparkSession, folder: str, names=TABLES) -> list[str]:
    """Register the tables as temporary views, so plain ``spark.sql`` can name them."""
    for name in names:
        load_table(spark, folder, name).createOrReplaceTempView(name)
    return sorted(t.name for t in spark.catalog.listTables() if t.name in set(names))


def describe_schema(df: DataFrame) -> DataFrame:
    """Column name, type and nullability, one row per column (metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return literal_table(df.sparkSession, rows, ["position", "column_name", "dtype", "nullable"])


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The bounded preview: any ``rows`` rows, without a sort."""
    return df.limit(rows)
