"""Imputation, encoders and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.scalars import totals
from tallymill.operators.cleaning import most_frequent
from tallymill.operators.quantiles import exact_quantiles
from tallymill.operators.ranking import global_rank
from tallymill.session import stored


def impute(df: DataFrame, spec: Mapping, fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls per column: ``'median'``, ``'most_frequent'`` or ``('constant', value)``.

    The fill values come from ``fit_on`` (the training rows) when it is given.
    """
    source = df if fit_on is None else fit_on
    fills = {}
    for col, how in spec.items():
        if how == "median":
            value = exact_quantiles(source, col, [0.5], names=["m"]).scalar()
        elif how == "most_frequent":
            value = most_frequent(source, col)
        elif isinstance(how, tuple) and how[0] == "constant":
            value = F.lit(how[1])
        else:
            raise ValueError(f"unknown imputation for {col}: {how!r}")
        fills[col] = F.coalesce(F.col(col), value)
    return df.withColumns(fills)


def ordinal_code(col: str, grades: Sequence[str], strict: bool = True) -> Column:
    """Index of the grade; null stays null, an unknown grade raises (or is null)."""
    pairs = [F.lit(x) for i, g in enumerate(grades) for x in (g, i)]
    code = F.try_element_at(F.create_map(*pairs), F.col(col))
    if not strict:
        return code
    problem = F.raise_error(F.concat(F.lit(f"unknown grade in {col}: "), F.col(col)))
    known = F.col(col).isNull() | F.col(col).isin(list(grades))
    return F.when(known, code).otherwise(problem.cast("int"))


def ordinal_encode(
    df: DataFrame, cols: Sequence[str], grades: Sequence[str], strict: bool = True
) -> DataFrame:
    return df.withColumns({c: ordinal_code(c, grades, strict) for c in cols})


def factorize(df: DataFrame, col: str, name: str) -> DataFrame:
    """Dense codes of the distinct values in sorted order, -1 for null.

    The distinct values are numbered block by block, so an identifier column with
    billions of values works too.
    """
    values = df.where(F.col(col).isNotNull()).select(col).distinct()
    codes = global_rank(values, [col], "_code")
    return df.join(codes, col, "left").select(
        *df.columns, F.coalesce(F.col("_code") - 1, F.lit(-1)).cast("int").alias(name)
    )


def fit_m_estimate(train: DataFrame, cat: str, target: str, name: str, m: float = 5.0) -> DataFrame:
    """Smoothed mean of the target per category: (sum + m * prior) / (n + m).

    The prior is the training mean; it is also the value of the null category, the
    row that :func:`apply_encoding` gives to unseen categories.
    """
    prior = train.agg(F.avg(target)).scalar()
    seen = (
        train.where(F.col(cat).isNotNull())
        .groupBy(cat)
        .agg(F.sum(target).alias("_sum"), F.count(target).alias("_n"))
        .select(cat, ((F.col("_sum") + prior * m) / (F.col("_n") + m)).alias(name))
    )
    unseen = train.agg(F.avg(target).alias(name)).select(
        F.lit(None).cast(train.schema[cat].dataType).alias(cat), name
    )
    return seen.unionByName(unseen)


def apply_encoding(df: DataFrame, table: DataFrame, cat: str, name: str) -> DataFrame:
    """Attach the encoding table; unseen and null categories get its null row.

    A stored table is broadcast when its files are small enough, without a hint.
    """
    unseen = table.where(F.col(cat).isNull()).select(name).scalar()
    known = table.where(F.col(cat).isNotNull()).withColumnRenamed(name, "_known")
    return df.join(known, cat, "left").select(
        *df.columns, F.coalesce(F.col("_known"), unseen).alias(name)
    )


def m_estimate_encode(
    train: DataFrame, df: DataFrame, cat: str, target: str, name: str, m: float = 5.0
) -> DataFrame:
    """Fit on ``train`` and encode ``df``.

    The category table is written once: fitting is not repeated for every use, and
    its known size lets the join broadcast it instead of shuffling ``df``.
    """
    table = stored(fit_m_estimate(train, cat, target, name, m), "encoding")
    return apply_encoding(df, table, cat, name)


def sample_bucket(ids: Sequence[str], seed: int, buckets: int = 100) -> Column:
    """Pseudo-random bucket 0..``buckets``-1 of a row, fixed by its key and the seed.

    Unlike a random split it gives the same answer when a lost task is run again.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ids], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def target_encoding(
    df: DataFrame, cat: str, target: str, ids: Sequence[str], seed: int, m: float = 5.0,
    percent: int = 20, name: str | None = None,
) -> DataFrame:
    """Fit the encoder on a sample of the rows and encode the remaining rows with it."""
    held_out = sample_bucket(ids, seed) < percent
    return m_estimate_encode(df.where(held_out), df.where(~held_out), cat, target, name or cat + "_enc", m)


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Z-scores with the sample deviation; a constant column becomes null."""
    source = df if fit_on is None else fit_on
    stats = totals(
        source,
        **{f"m_{c}": F.avg(c) for c in cols},
        **{f"s_{c}": F.stddev_samp(c) for c in cols},
    )
    return (
        df.withColumn("_s", stats)
        .withColumns(
            {c: F.try_divide(F.col(c) - F.col(f"_s.m_{c}"), F.col(f"_s.s_{c}")) for c in cols}
        )
        .drop("_s")
    )
