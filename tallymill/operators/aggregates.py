"""Group counts, shares, period comparison and multi-level aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.scalars import literal_table
from tallymill.operators.cuts import long_groups, with_blocks

_FNS = {"mean": F.avg, "count": F.count, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp}


def _present(cols: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


def yoy_growth(
    df: DataFrame, keys: Sequence[str], period: Column, p0, p1, min_delta: float
) -> DataFrame:
    """Groups present in both periods that grew by more than ``min_delta`` rows.

    One scan and one shuffle: both counts are conditional aggregates of the same
    grouping instead of two aggregates joined.
    """
    counted = (
        df.where(period.isin(p0, p1) & _present(keys))
        .groupBy(*keys)
        .agg(
            F.count_if(period == F.lit(p0)).alias("n_before"),
            F.count_if(period == F.lit(p1)).alias("n_after"),
        )
    )
    delta = F.col("n_after") - F.col("n_before")
    return counted.where(
        (F.col("n_before") > 0) & (F.col("n_after") > 0) & (delta > min_delta)
    ).withColumn("increase_percent", F.try_divide(delta, F.col("n_before")) * 100)


def nested_average(
    df: DataFrame,
    levels: Sequence[tuple[Sequence[str], Mapping[str, Column]]],
    keep: Column | None,
    result: Mapping[str, Column],
) -> DataFrame:
    """Aggregate level by level (session, then user), filter, then aggregate the whole."""
    for keys, aggs in levels:
        df = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    if keep is not None:
        df = df.where(keep)
    return df.agg(*[e.alias(n) for n, e in result.items()])


def multi_agg(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], fns: Sequence[str]
) -> DataFrame:
    """Every function on every column per group, named ``column_function``."""
    return (
        df.where(_present(keys))
        .groupBy(*keys)
        .agg(*[_FNS[f](c).alias(f"{c}_{f}") for c in cols for f in fns])
    )


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Rows per non-null value, most frequent first, ties by value."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), F.asc(col))
    )


def share(
    df: DataFrame, keys: Sequence[str], name: str = "share", scale: float = 1.0, count: str = "n"
) -> DataFrame:
    """Rows per group and their share of all rows of ``df``."""
    everything = df.agg(F.count(F.lit(1))).scalar()
    counted = df.where(_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return counted.withColumn(name, F.col(count) / everything * F.lit(scale))


def complete_categories(
    counts: DataFrame, col: str, labels: Sequence[str], value: str
) -> DataFrame:
    """One row per label, in the order given, with 0 where ``counts`` has none."""
    dim = literal_table(counts.sparkSession, enumerate(labels), ["_rank", col])
    return (
        dim.join(counts.select(col, value), col, "left")
        .select("_rank", col, F.coalesce(F.col(value), F.lit(0)).alias(value))
        .orderBy("_rank")
        .drop("_rank")
    )


def ordered_path(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    block: Column | None = None,
    sep: str = "->",
    name: str = "path",
    rows: int = 100_000,
) -> DataFrame:
    """Values of each group joined to one text in order.

    A group of more than ``rows`` rows is cut at quantiles of its first order column; each
    piece is sorted and joined on its own, then the texts of the pieces are joined in turn.
    ``block`` gives the pieces instead; it must never decrease along ``order``.
    """
    by = ", ".join(f"`{c}`" for c in order)
    quoted = sep.replace("'", "\\'")
    if block is None:
        cuts = long_groups(df, keys, order[0], rows)
        cut = with_blocks(df, keys, order[0], cuts)
        # Without an order value rows come first, as in the sort below.
        cut = cut.withColumn("_block", F.when(F.col(order[0]).isNull(), -1).otherwise(F.col("_block")))
    else:
        cuts, cut = df, df.withColumn("_block", block)
    parts = cut.groupBy(*keys, *(["_block"] if cuts is not None else [])).agg(
        F.expr(f"listagg(`{value}`, '{quoted}') within group (order by {by})").alias("_part")
    )
    if cuts is None:
        return parts.select(*keys, F.coalesce(F.col("_part"), F.lit("")).alias(name))
    joined = parts.groupBy(*keys).agg(
        F.expr(f"listagg(_part, '{quoted}') within group (order by _block)").alias(name)
    )
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit("")))
