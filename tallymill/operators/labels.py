"""Labels of any number as table rows, and sparse vectors instead of a column per label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.ranking import global_rank
from tallymill.session import stored


def label_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, index): the distinct labels of each column as text, numbered in order from 0.

    All columns in one pass; the labels are numbered block by block and written, and none
    comes to the driver. Nulls are no label.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in cols])
    found = df.select(F.inline(cells)).where(F.col("label").isNotNull()).distinct()
    ranked = stored(global_rank(found, ["column", "label"], "rank"), "label-ranks")
    first = ranked.groupBy("column").agg(F.min("rank").alias("_first"))
    numbered = ranked.join(F.broadcast(first), "column").select(
        "column", "label", (F.col("rank") - F.col("_first")).cast("int").alias("index")
    )
    return stored(numbered, "label-index")


def label_counts(index: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """How many labels each column has; one number per column comes to the driver."""
    found = {r["column"]: r["n"] for r in index.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def with_codes(
    df: DataFrame, index: DataFrame, cols: Sequence[str], fill: Mapping[str, Column] | None = None, suffix: str = "_code"
) -> DataFrame:
    """Add the number of each column's label, null for a null or unknown one.

    ``fill`` gives the label that stands for a null. The label tables are joined; Spark
    sends small ones to the rows and splits the rows of a hot label otherwise.
    """
    for c in cols:
        own = index.where(F.col("column") == c).select(
            F.col("label").alias("_label"), F.col("index").alias(f"{c}{suffix}")
        )
        label = F.col(f"`{c}`").cast("string")
        label = F.coalesce(label, fill[c]) if fill and c in fill else label
        df = df.join(own, label == F.col("_label"), "left").drop("_label")
    return df


def one_hot_vectors(
    df: DataFrame,
    index: DataFrame,
    sizes: Mapping[str, int],
    fill: Mapping[str, Column] | None = None,
    suffix: str = "_vector",
) -> DataFrame:
    """Add one sparse 0/1 vector per column of ``sizes``; an unknown label is all zeros."""
    cols = [c for c in sizes if sizes[c]]
    coded = with_codes(df, index, cols, fill, "_code_")
    # One number beyond the labels stands for unknown, and the encoder drops the last one.
    coded = coded.withColumns({f"{c}_code_": F.coalesce(F.col(f"{c}_code_"), F.lit(sizes[c])).cast("double") for c in cols})
    sample = df.sparkSession.range(1).select(*[F.lit(float(sizes[c])).alias(f"{c}_code_") for c in cols])
    encoder = OneHotEncoder(
        inputCols=[f"{c}_code_" for c in cols], outputCols=[f"{c}{suffix}" for c in cols], dropLast=True
    )
    return encoder.fit(sample).transform(coded).drop(*[f"{c}_code_" for c in cols]) if cols else df
