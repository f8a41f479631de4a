"""Per-family forecasting: ridge, boosted trees on its residuals, policy, storage."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.functions.calendar import future_dates, seasonal_terms
from tallymill.functions.columns import clip_lower
from tallymill.operators.boosting import best_rounds, fit_boosted, lay_out, predict_boosted
from tallymill.operators.labels import label_index
from tallymill.operators.linear import fit_blocked_ridge, fit_series_ols, predict_blocked
from tallymill.operators.series import (
    FeatureSpec,
    PanelColumns,
    build_features,
    build_forecast_features,
    date_index,
    fit_spec,
)
from tallymill.operators.stats import choose_policy, family_metrics
from tallymill.operators.windows import autocorr
from tallymill.session import stored

# The searched values of the boosted stage.
DEFAULT_GRID = {"maxDepth": [3, 5], "stepSize": [0.1], "maxIter": [20], "minInstancesPerNode": [5]}
_TREE_FIXED = {"subsamplingRate": 0.7, "featureRate": 0.7}


def time_split(df: DataFrame, date: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``cut`` and rows from it on."""
    day = F.lit(cut).cast(df.schema[date].dataType)
    return df.where(F.col(date) < day), df.where(F.col(date) >= day)


def parameter_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid's values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def in_parallel(spark: SparkSession, tasks: Sequence[Callable], threads: int = 4) -> list:
    """Run driver functions that submit Spark jobs side by side."""
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


def residual_bias(df: DataFrame, groups: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Mean residual per group."""
    return df.groupBy(*groups).agg(F.avg(F.col(actual) - F.col(predicted)).alias("bias"))


def combine_forecast(
    base: Column, correction: Column | None = None, gate: Column | None = None, floor: float | None = 0.0
) -> Column:
    """Base plus correction, times the activity gate, not below ``floor``."""
    out = base if correction is None else base + correction
    out = out if gate is None else out * gate
    return out if floor is None else clip_lower(out, floor)


def fit_store_ridge(
    rows: DataFrame, spec: FeatureSpec, cols: PanelColumns, alpha: float
) -> tuple[DataFrame, DataFrame]:
    """Ridge of every family with an offset and a slope per store, however many stores there are."""
    return fit_blocked_ridge(
        rows, [cols.family], cols.store, spec.shared_columns(), spec.own_columns(), cols.value, alpha
    )


def predict_store_ridge(
    rows: DataFrame, ridge: tuple[DataFrame, DataFrame], spec: FeatureSpec, cols: PanelColumns, name: str
) -> DataFrame:
    return predict_blocked(
        rows, *ridge, [cols.family], cols.store, spec.shared_columns(), spec.own_columns(), name
    )


def fit_residual_trees(
    rows: DataFrame,
    groups: Sequence[str],
    features: Sequence[str],
    target: str,
    settings: Sequence[Mapping],
    order: Sequence[str],
    validation: Column | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """The best boosted trees of every group, all groups and settings in the same jobs.

    Rows of ``validation`` grow no tree: by their error the setting and the number of trees
    are chosen, as training error would always prefer the deepest trees. Without them each
    group keeps all trees of its first setting. ``order`` tells rows of a group apart.
    """
    chunks = lay_out(rows, groups, features, target, order, validation)
    fitted = fit_boosted(chunks, groups, [{**_TREE_FIXED, **s} for s in settings], wanted)
    return stored(best_rounds(fitted, groups), "residual-trees")


@dataclass
class FamilyModels:
    """What prediction needs, as tables.

    Linear parameters per family and per family and store, kept dates, store numbers, and
    the trees per family.
    """

    spec: FeatureSpec
    params: DataFrame
    index: DataFrame
    blocks: DataFrame
    stores: DataFrame
    boosted: DataFrame | None = None
    trees: dict[str, dict] = field(default_factory=dict)


def diagnose(
    panel: DataFrame,
    split_date: str,
    validation_cut: str,
    lags: Sequence[int] = (1, 7, 28),
    rolls: Sequence[int] = (7,),
    alpha: float = 4.0,
    grid: Mapping[str, Sequence] = DEFAULT_GRID,
    cols: PanelColumns = PanelColumns(),
    gate: bool = True,
) -> tuple[DataFrame, DataFrame, dict[str, dict]]:
    """Hybrid forecast of every family and its metrics.

    All stages run for all families at once. Returns the scored rows, the metrics table
    with the policy, and the best tree parameters per family.
    """
    spec = fit_spec(panel, cols, lags, rolls, wide=False)
    tree, codes = spec.tree_columns(), label_index(panel, [cols.store])
    rows = stored(build_features(panel, lags, rolls, cols, spec, codes=codes), "features")
    train, _ = time_split(rows, cols.date, split_date)
    ridge = fit_store_ridge(train, spec, cols, alpha)
    fitted = predict_store_ridge(train, ridge, spec, cols, "lr_pred")
    bias = residual_bias(fitted, [cols.family], cols.value, "lr_pred")
    scored = (
        predict_store_ridge(rows, ridge, spec, cols, "lr_pred")
        .join(bias, cols.family, "left")
        .withColumn("lr_pred_corr", F.col("lr_pred") + F.col("bias"))
        .withColumn("lr_residual", F.col(cols.value) - F.col("lr_pred_corr"))
        .drop("bias")
    )
    scored = stored(scored, "scored")
    known, _ = time_split(scored, cols.date, split_date)
    settings = parameter_grid(grid)
    trees = fit_residual_trees(
        known,
        [cols.family],
        tree,
        "lr_residual",
        settings,
        [cols.store, cols.date],
        F.col(cols.date) >= F.lit(validation_cut).cast(panel.schema[cols.date].dataType),
    )
    corrected = (
        predict_boosted(scored, trees, [cols.family], tree, "xgb_pred")
        .withColumn("xgb_pred", F.coalesce("xgb_pred", F.lit(0.0)))
        .withColumn(
            "hybrid_pred",
            combine_forecast(
                F.col("lr_pred_corr"), F.col("xgb_pred"), F.col("is_active") if gate else None, floor=None
            ),
        )
    )
    _, test = time_split(corrected, cols.date, split_date)
    slopes = (
        ridge[1]
        .where(F.col(cols.store) != F.lit(spec.stores[0]))
        .groupBy(cols.family)
        .agg(F.var_pop(F.get("own_coef", F.lit(1))).alias("store_slope_variance"))
    )
    acf = autocorr(
        scored, [cols.family], [cols.store], cols.date, "lr_residual", flat=True, name="mean_residual_acf"
    )
    metrics = (
        family_metrics(test, [cols.family], cols.value, "lr_pred_corr", "hybrid_pred", "xgb_pred")
        .join(acf, cols.family, "left")
        .join(slopes, cols.family, "left")
    )
    best = {r[0]: settings[r[1]] for r in trees.select(cols.family, "setting").collect()}
    return corrected, choose_policy(metrics), best


def train_all(
    panel: DataFrame,
    policies: Mapping[str, str],
    tree_params: Mapping[str, Mapping],
    alpha: float = 4.0,
    cols: PanelColumns = PanelColumns(),
) -> FamilyModels:
    """Fit every family on all rows with future-safe features.

    Ridges, and the trees of all families with policy 'hybrid', are each fitted in the same
    jobs; families that share their parameters share a setting.
    """
    spec = fit_spec(panel, cols, wide=False)
    index, codes = date_index(panel, cols), label_index(panel, [cols.store])
    tree = spec.tree_columns()
    rows = stored(build_forecast_features(panel, spec, None, cols, codes), "features")
    ridge = fit_store_ridge(rows, spec, cols, alpha)
    params, blocks = ridge
    fitted = predict_store_ridge(rows, ridge, spec, cols, "lr_pred")
    bias = residual_bias(fitted, [cols.family], cols.value, "lr_pred")
    spark, kind = panel.sparkSession, panel.schema[cols.family].dataType.simpleString()
    chosen = spark.createDataFrame(list(policies.items()), f"`{cols.family}` {kind}, policy string")
    params = (
        params.join(bias, cols.family)
        .join(chosen, cols.family, "left")
        .withColumn("policy", F.coalesce("policy", F.lit("lr")))
    )
    residual = (
        predict_store_ridge(rows, ridge, spec, cols, "lr_pred")
        .join(params.select(cols.family, "bias"), cols.family)
        .withColumn("lr_residual", F.col(cols.value) - F.col("lr_pred") - F.col("bias"))
    )
    hybrid = [f for f, p in policies.items() if p == "hybrid"]

    if not hybrid:
        return FamilyModels(spec, params, index, blocks, codes)
    settings = [dict(s) for s in {tuple(sorted(tree_params[f].items())): tree_params[f] for f in hybrid}.values()]
    wanted = spark.createDataFrame(
        [(f, [settings.index(dict(tree_params[f]))]) for f in hybrid],
        f"`{cols.family}` {kind}, settings array<int>",
    )
    boosted = fit_residual_trees(
        residual, [cols.family], tree, "lr_residual", settings, [cols.store, cols.date], None, wanted
    )
    return FamilyModels(spec, params, index, blocks, codes, boosted, {f: dict(tree_params[f]) for f in hybrid})


def predict_all(df: DataFrame, models: FamilyModels, cols: PanelColumns = PanelColumns(), name: str = "sales") -> DataFrame:
    """Forecast every row of ``df``; families without trees use the ridge alone."""
    tree = models.spec.tree_columns()
    rows = build_forecast_features(df, models.spec, models.index, cols, models.stores)
    base = (
        predict_store_ridge(rows, (models.params, models.blocks), models.spec, cols, "_lr")
        .join(models.params.select(cols.family, "bias"), cols.family, "left")
        .withColumn("_lr", F.col("_lr") + F.col("bias"))
    )
    if models.boosted is None:
        return base.select(*df.columns, combine_forecast(F.col("_lr")).alias(name))
    scored = predict_boosted(stored(base, "base-forecast"), models.boosted, [cols.family], tree, "_trees")
    return scored.select(
        *df.columns, combine_forecast(F.col("_lr"), F.coalesce("_trees", F.lit(0.0))).alias(name)
    )


def save_models(models: FamilyModels, path: str) -> None:
    """Parameters, kept dates and trees as parquet tables, the rest as one line of JSON."""
    spark = models.params.sparkSession
    models.params.write.mode("overwrite").parquet(os.path.join(path, "params"))
    models.index.write.mode("overwrite").parquet(os.path.join(path, "index"))
    models.blocks.write.mode("overwrite").parquet(os.path.join(path, "blocks"))
    models.stores.write.mode("overwrite").parquet(os.path.join(path, "stores"))
    if models.boosted is not None:
        models.boosted.write.mode("overwrite").parquet(os.path.join(path, "trees"))
    meta = json.dumps({"spec": models.spec.to_dict(), "trees": models.trees})
    spark.range(1).select(F.lit(meta).alias("value")).coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "meta")
    )


def load_models(spark: SparkSession, path: str) -> FamilyModels:
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    return FamilyModels(
        FeatureSpec(**meta["spec"]),
        spark.read.parquet(os.path.join(path, "params")),
        spark.read.parquet(os.path.join(path, "index")),
        spark.read.parquet(os.path.join(path, "blocks")),
        spark.read.parquet(os.path.join(path, "stores")),
        spark.read.parquet(os.path.join(path, "trees")) if meta["trees"] else None,
        meta["trees"],
    )


def seasonal_fit_predict(
    panel: DataFrame, keys: Sequence[str], date: str, value: str, steps: int
) -> DataFrame:
    """Seasonal regression of every series and its next ``steps`` days."""
    origin = panel.agg(F.min(date).cast("date")).scalar()
    in_sample = panel.withColumn("_origin", origin)
    terms = seasonal_terms(F.col(date), F.col("_origin"))
    rows = in_sample.withColumns(terms).drop("_origin")
    names = list(terms)
    params = fit_series_ols(rows, keys, names, value)
    ahead = params.withColumn(
        "_days", future_dates(panel, date, steps).agg(F.array_sort(F.collect_list(date))).scalar()
    ).withColumn("_origin", origin)
    days = ahead.select(*keys, "coef", "intercept", "_origin", F.explode("_days").alias(date))
    value_of = F.col("intercept")
    future_terms = seasonal_terms(F.col(date), F.col("_origin"))
    days = days.withColumns(future_terms)
    for i, term in enumerate(names):
        value_of = value_of + F.col(term) * F.col("coef")[i]
    return days.select(*keys, date, value_of.alias("prediction"))
