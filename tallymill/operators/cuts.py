"""Cutting long groups into pieces that follow each other along an order.

Most groups are short and stay whole. Only a group of more than ``rows`` rows is cut, at
quantiles of its first order column, so that a user or a series with a third of a table
becomes many pieces of about the same size, whatever its dates or hours look like.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.session import stored

_LEVELS = 1000


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Equality of the keys with the other side's, which begin with ``prefix``; nulls are equal."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"`{k}`").eqNullSafe(F.col(f"`{prefix}{k}`"))
    return out


def long_groups(df: DataFrame, keys: Sequence[str], order: str, rows: int) -> DataFrame | None:
    """(prefixed keys, cuts) of the groups of more than ``rows`` rows; None where there are none.

    ``cuts`` are ascending values of ``order`` at which a piece begins. One row per long
    group is written; the sums behind it combine before they are shuffled.
    """
    size = F.count(F.lit(1))
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    counted = stored(df.groupBy(*named).agg(size.alias("_n")).where(F.col("_n") > rows), "long-groups")
    if counted.isEmpty():
        return None
    inside = df.join(counted, same_keys(keys, "_k_"))
    levels = F.percentile_approx(F.col(order), F.array(*[F.lit(i / _LEVELS) for i in range(_LEVELS)]), F.lit(10_000))
    # Partial quantiles of a group come from many tasks; the sketches meet in one.
    marks = inside.groupBy(*[f"_k_{k}" for k in keys], "_n").agg(levels.alias("_levels"))
    pieces = F.least(F.ceil(F.col("_n") / rows), F.lit(_LEVELS)).cast("int")
    cuts = F.transform(
        F.sequence(F.lit(1), pieces - 1), lambda i: F.get("_levels", (i * _LEVELS / pieces).cast("int"))
    )
    return stored(
        marks.select(*[f"_k_{k}" for k in keys], F.array_sort(F.array_distinct(F.coalesce(cuts, F.array()))).alias("_cuts")),
        "group-cuts",
    )


def with_blocks(df: DataFrame, keys: Sequence[str], order: str, cuts: DataFrame | None) -> DataFrame:
    """``df`` with ``_block``: the number of the row's piece in its group, nulls of ``order`` last."""
    if cuts is None:
        return df.withColumn("_block", F.lit(0))
    passed = F.size(F.filter("_cuts", lambda c: c <= F.col(order)))
    found = F.when(F.col("_cuts").isNull(), 0).when(F.col(order).isNull(), F.size("_cuts") + 1).otherwise(passed)
    return df.join(cuts, same_keys(keys, "_k_"), "left").select(*df.columns, found.alias("_block"))
