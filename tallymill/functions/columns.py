"""Column arithmetic over sets of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once per row.

    A column that is named inside a higher-order function's lambda may be replaced by its
    definition and worked out again for every element; a lambda's own variable is not.
    """
    return F.transform(F.array(value), body)[0]


def clip_lower(value: Column, bound: float = 0.0) -> Column:
    """``value`` raised to ``bound``; null stays null (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def pearson(x: Column, y: Column) -> Column:
    """Correlation aggregate over rows where both are present; null for a constant column.

    The built-in divides by zero on a constant column in ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """``sum / sum`` that is null, not an error, on an empty denominator."""
    return F.try_divide(F.sum(numerator), F.sum(denominator))


def count_positive(df: DataFrame, cols: Iterable[str], name: str) -> DataFrame:
    """How many of ``cols`` are greater than zero in each row; null counts as no."""
    flags = [F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for c in cols]
    return df.withColumn(name, reduce(lambda a, b: a + b, flags, F.lit(0)))


def combine_columns(df: DataFrame, cols: Iterable[str], name: str) -> DataFrame:
    """Replace ``cols`` by their sum; null if any of them is null."""
    cols = list(cols)
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(c) for c in cols])).drop(
        *[c for c in cols if c != name]
    )


def ratio_features(df: DataFrame, spec: Mapping[str, tuple]) -> DataFrame:
    """``spec[name] = (numerator columns, denominator columns or None)``.

    The value is the sum of the first over the sum of the second; a zero
    denominator gives null.
    """
    def add(cols):
        return reduce(lambda a, b: a + b, [F.col(c) for c in cols])

    out = {}
    for name, (top, bottom) in spec.items():
        out[name] = add(top) if not bottom else F.try_divide(add(top), add(bottom))
    return df.withColumns(out)


def regex_recode(value: Column, rules: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """Label of the first pattern that matches the whole text; unmatched text stays."""
    out = None
    for pattern, label in rules.items():
        hit = value.rlike(f"^(?:{pattern})$")
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    fallback = value if otherwise is None else otherwise
    return fallback if out is None else out.otherwise(fallback)


def align_columns(df: DataFrame, cols: Iterable[str], fill=0, keep: Iterable[str] = ()) -> DataFrame:
    """Exactly ``keep`` + ``cols``, in that order; absent columns become ``fill``."""
    present = set(df.columns)
    picked = [F.col(c) if c in present else F.lit(fill).alias(c) for c in cols]
    return df.select(*[F.col(c) for c in keep], *picked)
