"""One-row aggregates used as values inside another query.

Spark runs a scalar subquery once and hands the value to every task, so a global
maximum or mean needs neither a driver round trip nor a join with a one-row side.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def total(df: DataFrame, expr: Column) -> Column:
    """Whole-table aggregate ``expr`` as a scalar."""
    return df.agg(expr.alias("value")).scalar()


def totals(df: DataFrame, **exprs: Column) -> Column:
    """Several whole-table aggregates as one struct scalar; read with ``["name"]``."""
    return df.agg(F.struct(*[e.alias(n) for n, e in exprs.items()]).alias("value")).scalar()


def literal_table(spark: SparkSession, rows: Iterable[Sequence], cols: Sequence[str]) -> DataFrame:
    """A small table written in the code, built without a Python worker."""
    cells = [F.struct(*[F.lit(v).alias(c) for c, v in zip(cols, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*cells)))
