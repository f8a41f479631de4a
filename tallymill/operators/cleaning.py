"""Null handling, column choice, lookups and output checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

_KINDS = {
    "number": (NumericType,),
    "text": (StringType,),
    "boolean": (BooleanType,),
    "time": (DateType, TimestampType, TimestampNTZType),
}



def most_frequent(df: DataFrame, col: str) -> Column:
    """The most frequent non-null value (smallest of ties) as a scalar.

    Counts per value and keeps the best one, so no task ever holds all values; the
    ``mode`` aggregate would.
    """
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(col))
        .limit(1)
        .select(col)
        .scalar()
    )


def fill_mode(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), most_frequent(df, col)))


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names of kind ``number``, ``text``, ``boolean`` or ``time``."""
    types = _KINDS[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def null_count_exprs(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]


def keep_dense_columns(df: DataFrame, max_nulls: int) -> DataFrame:
    """Columns with fewer than ``max_nulls`` nulls. Runs one aggregation to choose them."""
    counts = df.agg(*null_count_exprs(df)).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] < max_nulls])


def low_cardinality_columns(df: DataFrame, n: int, cols: list[str] | None = None) -> list[str]:
    """Text columns with fewer than ``n`` distinct values, by an exact count of digests."""
    cols = columns_of_type(df, "text") if cols is None else cols
    if not cols:
        return []
    exact = df.agg(*[F.count_distinct(F.sha2(c, 256)).alias(c) for c in cols]).first()
    return [c for c in cols if exact[c] < n]


def rows_at_extreme(df: DataFrame, col: str, which: str = "max") -> DataFrame:
    """All rows whose ``col`` equals the whole table's maximum or minimum."""
    pick = {"max": F.max, "min": F.min}[which]
    return df.where(F.col(col) == df.agg(pick(col)).scalar())


def map_values(
    df: DataFrame, col: str, mapping: Mapping | DataFrame, name: str, kind: str = "string"
) -> DataFrame:
    """Look ``col`` up in a dictionary or a two-column table; null where it is missing.

    ``kind`` is the type of a dictionary's values. It is one join in every case; Spark
    sends the table to all tasks when its size allows that.
    """
    if isinstance(mapping, DataFrame):
        dim = mapping.toDF("_lookup_key", name)
    else:
        key = df.schema[col].dataType.simpleString()
        dim = df.sparkSession.createDataFrame(list(mapping.items()), f"_lookup_key {key}, `{name}` {kind}")
    return df.join(dim, F.col(col) == F.col("_lookup_key"), "left").drop("_lookup_key")


def assert_output(df: DataFrame, expected_rows: int, col: str) -> DataFrame:
    """Raise unless ``df`` kept its row count and ``col`` is never null or negative."""
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(col).isNull()).alias("nulls"),
        F.count_if(F.col(col) < 0).alias("negative"),
    ).first()
    if seen["rows"] != expected_rows:
        raise ValueError(f"expected {expected_rows} rows, found {seen['rows']}")
    if seen["nulls"] or seen["negative"]:
        raise ValueError(f"{col}: {seen['nulls']} null and {seen['negative']} negative values")
    return df
