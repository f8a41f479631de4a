"""Pivots, list columns, dummy and interaction columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_table(
    df: DataFrame,
    index: Sequence[str],
    columns: str,
    agg: Column,
    values: Sequence,
    fill=None,
    prefix: str = "",
) -> DataFrame:
    """Rows ``index``, one column per entry of ``values`` holding ``agg``.

    The column values are given, so no extra job looks for them.
    """
    out = df.groupBy(*index).pivot(columns, list(values)).agg(agg)
    renamed = [F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values]
    out = out.select(*index, *renamed)
    return out if fill is None else out.na.fill(fill, [f"{prefix}{v}" for v in values])


def explode_list(df: DataFrame, col: str, name: str, sep: str = ",") -> DataFrame:
    """One row per trimmed element of a delimited text; rows without a list stay."""
    pattern = "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in sep)
    return df.select("*", F.explode_outer(F.split(col, pattern)).alias(name)).withColumn(
        name, F.trim(name)
    )


def unpivot(df: DataFrame, keys: Sequence[str], cols: Sequence[str], names=("column", "value")) -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(keys), list(cols), *names)


def fit_labels(df: DataFrame, cols: Sequence[str], most: int = 10_000) -> dict[str, list]:
    """Sorted distinct labels per column, in one job for all columns.

    Every label becomes a column of the caller's table, so they all come to the driver. A
    column of clearly more than ``most`` labels raises ``ValueError`` before any does; a
    table of its labels (``label_index``) has no such bound.
    """
    if not cols:
        return {}
    found = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    large = [c for i, c in enumerate(cols) if found[i] > 1.2 * most]
    if large:
        raise ValueError(f"{large} have too many labels for a column each; use label_index")
    sets = df.agg(*[F.sort_array(F.collect_set(F.col(f"`{c}`"))).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return {c: list(sets[i]) for i, c in enumerate(cols)}


def dummy_name(prefix: str, label) -> str:
    return f"{prefix}_{label}".replace(" ", "_").replace(".", "_").replace("`", "")


def dummy_names(prefix: str, labels: Sequence) -> list[str]:
    """A name per label; labels that would share a name get their number behind it."""
    out: list[str] = []
    for i, label in enumerate(labels):
        name = dummy_name(prefix, label)
        while name in out:
            name = f"{name}_{i}"
        out.append(name)
    return out


def dummies(
    col: str, labels: Sequence, drop_first: bool = False, prefix: str | None = None
) -> dict[str, Column]:
    """0/1 columns for given labels; null and unknown labels are 0 everywhere."""
    kept = labels[1:] if drop_first else labels
    names = dummy_names(prefix or col, kept)
    return {
        n: F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)) for n, v in zip(names, kept, strict=True)
    }


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = False,
    labels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Replace ``cols`` by dummy columns, with the labels of the training data."""
    labels = fit_labels(df, cols) if labels is None else labels
    new = {}
    for col in cols:
        new.update(dummies(col, list(labels[col]), drop_first))
    return df.withColumns(new).drop(*cols)


def interaction(
    df: DataFrame,
    cat: str,
    num: str,
    labels: Sequence,
    suffix: str = "",
    prefix: str | None = None,
    drop_first: bool = False,
) -> DataFrame:
    """One column per label: ``num`` where the row has that label, else 0."""
    made = dummies(cat, list(labels), drop_first, prefix)
    return df.withColumns({f"{n}{suffix}": d * F.col(num) for n, d in made.items()})
