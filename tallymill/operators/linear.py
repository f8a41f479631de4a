"""Least squares and ridge fits of many groups in one Spark job.

Each task adds up its own rows' cross products per group; the small partial matrices
are then summed per group. A group with a third of all rows is therefore summed by
many tasks, and only one matrix per task and group is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import stored

# A task gives its partial sums away when it holds this many groups.
_HELD_GROUPS = 256


def _upper(matrix: np.ndarray) -> list[float]:
    return matrix[np.triu_indices(len(matrix))].tolist()


def cross_products(df: DataFrame, groups: Sequence[str], features: Sequence[str], target: str, spread: int = 16) -> DataFrame:
    """Per group the upper triangle of Z'Z for Z = (1, features, target).

    Rows with a null feature or target are skipped.
    """
    groups = list(groups)
    row = F.array(
        F.lit(1.0), *[F.col(c).cast("double") for c in features], F.col(target).cast("double")
    )
    rows = df.select(*groups, row.alias("_z")).where(~F.exists("_z", lambda v: v.isNull()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*groups).schema)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for key, part in pdf.groupby(groups, sort=False, dropna=False):
                z = np.stack(part["_z"].to_numpy())
                held[key] = held.get(key, 0.0) + z.T @ z
            if len(held) >= _HELD_GROUPS:
                yield frame(held)
                held = {}
        if held:
            yield frame(held)

    def frame(held: dict) -> pd.DataFrame:
        out = pd.DataFrame(list(held), columns=groups)
        out["_part"] = [_upper(m) for m in held.values()]
        return out

    parts = rows.mapInPandas(partial, f"{schema}, _part array<double>")
    return added_up(parts, groups, spread)


def added_up(parts: DataFrame, groups: Sequence[str], spread: int = 16) -> DataFrame:
    """``_part`` arrays of equal length added up per group.

    Partial sums of one group first meet in ``spread`` tasks, then in one. The salt is the
    number of the producing task, which is the same when that task runs again.
    """
    groups = list(groups)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for pdf in batches:
            for key, vector in zip(pdf[groups].itertuples(index=False, name=None), pdf["_part"]):
                held[key] = held[key] + vector if key in held else np.array(vector)
        if held:
            out = pd.DataFrame(list(held), columns=groups)
            out["_part"] = [v.tolist() for v in held.values()]
            yield out

    salted = (
        parts.withColumn("_salt", F.spark_partition_id() % spread)
        .repartition(*groups, "_salt")
        .drop("_salt")
        .mapInPandas(merge, parts.schema)
    )
    return salted.repartition(*groups).mapInPandas(merge, parts.schema)


def _unpack(vector, size: int) -> np.ndarray:
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = vector
    return full + np.triu(full, 1).T


def _solve(vector, size: int, alpha: float, intercept: bool) -> tuple[list[float], float, float]:
    gram = _unpack(vector, size)
    n = gram[0, 0]
    xtx, xty = gram[1:-1, 1:-1], gram[1:-1, -1]
    if not intercept:
        coef = np.linalg.lstsq(xtx + alpha * np.eye(len(xtx)), xty, rcond=None)[0]
        return coef.tolist(), 0.0, n
    mean_x, mean_y = gram[0, 1:-1] / n, gram[0, -1] / n
    centred = xtx - n * np.outer(mean_x, mean_x) + alpha * np.eye(len(xtx))
    coef = np.linalg.lstsq(centred, xty - n * mean_x * mean_y, rcond=None)[0]
    return coef.tolist(), float(mean_y - mean_x @ coef), n


def fit_linear(
    df: DataFrame,
    groups: Sequence[str],
    features: Sequence[str],
    target: str,
    alpha: float = 0.0,
    intercept: bool = True,
) -> DataFrame:
    """One row per group: ``coef`` (in feature order), ``intercept`` and row count ``n``.

    ``alpha`` is the ridge penalty on the coefficients, never on the intercept. A
    singular system gets its shortest solution.
    """
    size = len(features) + 2

    @F.pandas_udf("coef array<double>, intercept double, n double")
    def solve(parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [_solve(v, size, alpha, intercept) for v in parts], columns=["coef", "intercept", "n"]
        )

    products = cross_products(df, groups, features, target)
    return (
        products.withColumn("_fit", solve("_part"))
        .select(*groups, "_fit.coef", "_fit.intercept", F.col("_fit.n").cast("bigint").alias("n"))
    )


def predict_linear(
    df: DataFrame, params: DataFrame, groups: Sequence[str], features: Sequence[str], name: str
) -> DataFrame:
    """Add the group's linear prediction; stays in generated code, no Python."""
    value = F.col("intercept")
    for i, feature in enumerate(features):
        value = value + F.col(feature).cast("double") * F.col("coef")[i]
    return (
        df.join(params.select(*groups, "coef", "intercept"), list(groups), "left")
        .withColumn(name, value)
        .drop("coef", "intercept")
    )


def fit_ridge(df, groups, features, target, alpha: float = 4.0) -> DataFrame:
    return fit_linear(df, groups, features, target, alpha=alpha)


def fit_blocked_ridge(
    df: DataFrame,
    groups: Sequence[str],
    block: str,
    shared: Sequence[str],
    own: Sequence[str],
    target: str,
    alpha: float = 4.0,
) -> tuple[DataFrame, DataFrame]:
    """Ridge in which every ``block`` of a group has its own coefficients of the ``own`` features.

    The same solution as with one ``own`` column per block, zero outside it, but no such
    column exists: the own coefficients of a block only meet the shared ones, so they are
    eliminated block by block. What that leaves, a system of the size of ``shared`` however
    many blocks there are, is added up and solved per group, and each block's coefficients
    follow from it. The intercept is not penalised; ``alpha`` must be above 0.

    Returns ``coef`` (of ``shared``) and ``intercept`` per group, and ``own_coef`` per block.
    """
    groups, count, width = list(groups), 1 + len(shared), len(own)
    products = cross_products(df, [*groups, block], [*shared, *own], target)
    products = stored(products, "block-products")
    inside, last = slice(count, count + width), count + width

    def eliminated(vector) -> tuple:
        full = _unpack(vector, count + width + 1)
        inverse = np.linalg.inv(full[inside, inside] + alpha * np.eye(width))
        return full, full[:count, inside], inverse

    @F.pandas_udf("array<double>")
    def reduce_block(parts: pd.Series) -> pd.Series:
        out = []
        for v in parts:
            full, across, inverse = eliminated(v)
            left = full[:count, :count] - across @ inverse @ across.T
            right = full[:count, last] - across @ inverse @ full[inside, last]
            out.append(np.append(left.ravel(), right).tolist())
        return pd.Series(out)

    @F.pandas_udf("array<double>")
    def solve_shared(parts: pd.Series) -> pd.Series:
        out = []
        for v in parts:
            left, right = np.reshape(v[:-count], (count, count)), np.asarray(v[-count:])
            penalty = alpha * np.eye(count)
            penalty[0, 0] = 0
            out.append(np.linalg.lstsq(left + penalty, right, rcond=None)[0].tolist())
        return pd.Series(out)

    @F.pandas_udf("array<double>")
    def solve_own(parts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for v, beta in zip(parts, found):
            full, across, inverse = eliminated(v)
            out.append((inverse @ (full[inside, last] - across.T @ beta)).tolist())
        return pd.Series(out)

    reduced = added_up(products.select(*groups, reduce_block("_part").alias("_part")), groups)
    beta = stored(reduced.select(*groups, solve_shared("_part").alias("_beta")), "shared-coefficients")
    params = beta.select(
        *groups, F.slice("_beta", 2, max(1, len(shared))).alias("coef"), F.get("_beta", F.lit(0)).alias("intercept")
    )
    blocks = products.join(beta, groups).select(*groups, block, solve_own("_part", "_beta").alias("own_coef"))
    return params, stored(blocks, "block-coefficients")


def predict_blocked(
    df: DataFrame,
    params: DataFrame,
    blocks: DataFrame,
    groups: Sequence[str],
    block: str,
    shared: Sequence[str],
    own: Sequence[str],
    name: str,
) -> DataFrame:
    """Add the prediction of :func:`fit_blocked_ridge`; an unknown block has no part of its own."""
    value = F.lit(0.0)
    for i, feature in enumerate(own):
        value = value + F.col(feature).cast("double") * F.coalesce(F.get("own_coef", F.lit(i)), F.lit(0.0))
    out = predict_linear(df, params, groups, shared, "_shared")
    return (
        out.join(blocks.select(*groups, block, "own_coef"), [*groups, block], "left")
        .withColumn(name, F.col("_shared") + value)
        .drop("own_coef", "_shared")
    )


def fit_series_ols(df, series, terms, target) -> DataFrame:
    """Least squares of every series on the same terms, without intercept."""
    return fit_linear(df, series, terms, target, intercept=False)
