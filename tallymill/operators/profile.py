"""Table profiles: nulls, types, distinct texts, summary of a column."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymill.operators.quantiles import exact_quantiles

def profile(df: DataFrame, dataset_name: str | None = None) -> DataFrame:
    """One row per column: nulls, percent null, type, distinct values of text columns.

    One aggregation covers all columns.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, field in enumerate(df.schema.fields):
        col = F.col(f"`{field.name}`")
        aggs.append(F.count_if(col.isNull()).alias(f"_nulls_{i}"))
        if isinstance(field.dataType, StringType):
            # Digests are counted, so no text is shuffled.
            aggs.append(F.count_distinct(F.sha2(col, 256)).alias(f"_distinct_{i}"))
    rows = []
    for i, field in enumerate(df.schema.fields):
        text = isinstance(field.dataType, StringType)
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("feature_name"),
                F.col(f"_nulls_{i}").alias("amount_null"),
                (F.try_divide(F.col(f"_nulls_{i}"), F.col("_rows")) * 100).alias("percent_null"),
                F.lit(field.dataType.simpleString()).alias("dtype"),
                (F.col(f"_distinct_{i}") if text else F.lit(0).cast("bigint")).alias(
                    "total_cat_entries"
                ),
            )
        )
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if dataset_name is not None:
        out = out.select(F.lit(dataset_name).alias("dataset_name"), "*")
    return out


def profile_all(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The profiles of several tables under each other."""
    return reduce(lambda a, b: a.unionByName(b), [profile(df, name) for name, df in tables.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, largest first."""
    return (
        df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
        .select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("feature_name"), F.col(f"_{i}").alias("amount_null"))
                        for i, c in enumerate(df.columns)
                    ]
                )
            )
        )
        .orderBy(F.desc("amount_null"), "feature_name")
    )


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    names = ["q25", "q50", "q75"]
    quartiles = exact_quantiles(df, col, [0.25, 0.5, 0.75], names=names)
    return (
        df.agg(
            F.count(col).alias("count"),
            F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"),
            F.min(col).alias("min"),
            F.max(col).alias("max"),
        )
        .withColumn("_q", quartiles.select(F.struct(*names)).scalar())
        .select("count", "mean", "std", "min", *[F.col(f"_q.{n}").alias(n) for n in names], "max")
    )
