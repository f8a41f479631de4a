"""The list of named queries.

A query is a function of :class:`Tables`. ``sql`` is the same result in portable SQL;
it is absent where the result has no SQL form (trained models, iterative solvers).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.sources.tables import TABLES, load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return load_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is already registered")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def iso(day: Column) -> Column:
    """A date as text, so results compare across engines."""
    return F.date_format(day, "yyyy-MM-dd")


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round float columns for display and comparison; also turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), d) + F.lit(0.0) for c, d in digits.items()})
