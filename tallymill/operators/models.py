"""Preprocessing stage, tree regressors, grid search, clustering and components."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.cleaning import most_frequent
from tallymill.operators.encode import ordinal_code, sample_bucket
from tallymill.operators.forecast import in_parallel, parameter_grid
from tallymill.operators.labels import label_counts, label_index, one_hot_vectors
from tallymill.operators.quantiles import exact_quantiles
from tallymill.operators.reshape import dummies
from tallymill.session import ensure_checkpoint_dir, scratch_path, stored

# Labels of a column that may become a column each.
_MOST_COLUMNS = 10_000


class TablePreprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Column-wise imputation and encoding into one ``features`` vector.

    ``spec`` is a dictionary with any of
    ``median``: numeric columns filled by their exact median;
    ``constant``: {numeric column: fill value};
    ``one_hot``: text columns, filled by the most frequent value, unknown is all zero; their
    labels are written and joined, and become sparse vectors, so any number of them works;
    ``ordinal``: {column: {"grades": [...], "fill": grade or None}}, None fills by the
    most frequent value and an unknown grade is an error;
    ``target``: {"columns": [...], "label": column, "m": 5.0} for smoothed means. Their
    tables are written, and joined when rows are encoded, so any number of categories
    works. Give a lasting ``"folder"``, to ``target`` and beside ``one_hot``, to a model that
    outlives its application.
    """

    spec = Param(Params._dummy(), "spec", "what to do with which column (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, spec: Mapping) -> TablePreprocessor:
        return cls(spec=json.dumps(spec))

    def _fit(self, dataset: DataFrame) -> TablePreprocessorModel:
        spec = json.loads(self.getOrDefault(self.spec))
        ordinal = spec.get("ordinal", {})
        scalars = {}
        for c in spec.get("median", []):
            scalars[f"median_{c}"] = exact_quantiles(dataset, c, [0.5], names=["m"]).scalar()
        by_mode = [*spec.get("one_hot", []), *[c for c, o in ordinal.items() if o.get("fill") is None]]
        for c in by_mode:
            scalars[f"mode_{c}"] = most_frequent(dataset, c)
        target = spec.get("target")
        if target:
            scalars["prior"] = dataset.agg(F.avg(target["label"])).scalar()
        found = {}
        if scalars:
            # All fill values in one job over a single row.
            found = (
                dataset.sparkSession.range(1)
                .select(*[v.alias(k) for k, v in scalars.items()])
                .first()
                .asDict()
            )
        fitted = {
            "median": {c: found[f"median_{c}"] for c in spec.get("median", [])},
            "mode": {c: found[f"mode_{c}"] for c in by_mode},
            "labels": None,
            "sizes": {},
            "prior": found.get("prior"),
            "target": {},
        }
        if spec.get("one_hot"):
            index = label_index(dataset, spec["one_hot"])
            fitted["sizes"] = label_counts(index, spec["one_hot"])
            fitted["labels"] = self._written(index, "labels", spec)
        for c in target["columns"] if target else []:
            m, prior = target.get("m", 5.0), F.lit(fitted["prior"])
            means = (
                dataset.where(F.col(c).isNotNull())
                .groupBy(F.col(c).cast("string").alias("category"))
                .agg(F.sum(target["label"]).cast("double").alias("s"), F.count(target["label"]).alias("n"))
                .where("n > 0")
                .select("category", ((F.col("s") + m * prior) / (F.col("n") + m)).alias("mean"))
            )
            fitted["target"][c] = self._written(means, "target-means", target)
        return TablePreprocessorModel(spec=json.dumps(spec), fitted=json.dumps(fitted))

    @staticmethod
    def _written(table: DataFrame, name: str, how: Mapping) -> str:
        """The path of ``table``, below ``how["folder"]`` or the application's folder."""
        name = f"{name}-{uuid.uuid4().hex}"
        folder = how.get("folder")
        path = f"{folder.rstrip('/')}/{name}" if folder else scratch_path(table.sparkSession, name)
        table.write.parquet(path)
        return path


class TablePreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    spec = Param(Params._dummy(), "spec", "what to do with which column (JSON)", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "values learned in training (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}", fitted: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(json.loads(self.getOrDefault(self.fitted))["labels"])

    def _labels(self, col: str) -> list[str]:
        """The labels of a column, for callers that want a column each."""
        fitted = json.loads(self.getOrDefault(self.fitted))
        if fitted["sizes"][col] > _MOST_COLUMNS:
            raise ValueError(f"{col} has too many labels for a column each; use transform")
        index = self._index(SparkSession.active()).where(F.col("column") == col)
        return [r["label"] for r in index.orderBy("index").select("label").collect()]

    def _columns(self, vectors: bool = False) -> dict:
        """Expressions by feature name; with ``vectors`` the one-hot columns are one each."""
        spec = json.loads(self.getOrDefault(self.spec))
        fitted = json.loads(self.getOrDefault(self.fitted))
        out = {}
        for c in spec.get("median", []):
            out[c] = F.coalesce(F.col(c).cast("double"), F.lit(fitted["median"][c]))
        for c, value in spec.get("constant", {}).items():
            out[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(value)))
        for c in spec.get("one_hot", []):
            if vectors:
                out |= {c: F.col(f"{c}_vector_")} if fitted["sizes"][c] else {}
                continue
            labels, top = self._labels(c), fitted["mode"][c]
            for label, (name, hit) in zip(labels, dummies(c, labels).items()):
                filled = F.coalesce(hit.cast("double"), F.lit(0.0))
                # A missing value counts as the most frequent one.
                out[name] = F.when(F.col(c).isNull(), F.lit(float(label == top))).otherwise(filled)
        for c, how in spec.get("ordinal", {}).items():
            fill = how.get("fill") or fitted["mode"][c]
            code = ordinal_code(c, how["grades"])
            out[f"{c}_grade"] = F.coalesce(code, F.lit(how["grades"].index(fill))).cast("double")
        for i, c in enumerate(fitted["target"]):
            out[f"{c}_mean"] = F.coalesce(F.col(f"_mean_{i}"), F.lit(fitted["prior"]))
        return out

    def _with_means(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` with the fitted mean of each target-encoded category."""
        fitted = json.loads(self.getOrDefault(self.fitted))
        for i, (c, path) in enumerate(fitted["target"].items()):
            means = dataset.sparkSession.read.parquet(path).toDF(f"_category_{i}", f"_mean_{i}")
            dataset = dataset.join(
                means, F.col(c).cast("string") == F.col(f"_category_{i}"), "left"
            ).drop(f"_category_{i}")
        return dataset

    def feature_names(self) -> list[str]:
        return list(self._columns())

    def encode(self, dataset: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and one numeric column per feature."""
        return self._with_means(dataset).select(*keep, *[e.alias(n) for n, e in self._columns().items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = json.loads(self.getOrDefault(self.fitted))
        made = {f"_f_{n}": e for n, e in self._columns(vectors=True).items()}
        ready = self._with_means(dataset)
        if fitted["sizes"]:
            fill = {c: F.lit(fitted["mode"][c]).cast("string") for c in fitted["sizes"]}
            ready = one_hot_vectors(ready, self._index(dataset.sparkSession), fitted["sizes"], fill, "_vector_")
        wide = ready.withColumns(made).select(*dataset.columns, *made)
        return (
            VectorAssembler(inputCols=list(made), outputCol="features").transform(wide).drop(*made)
        )


def fit_forest(df: DataFrame, label: str, params: Mapping, seed: int = 1):
    """Random forest on a ``features`` vector."""
    return RandomForestRegressor(featuresCol="features", labelCol=label, seed=seed, **params).fit(df)


def fit_boosted(df: DataFrame, label: str, params: Mapping, seed: int = 42):
    """Boosted trees on a ``features`` vector."""
    ensure_checkpoint_dir(df.sparkSession)
    return GBTRegressor(featuresCol="features", labelCol=label, seed=seed, **params).fit(df)


def grid_search(
    df: DataFrame,
    preprocessor: TablePreprocessor,
    fit: Callable,
    grid: Mapping[str, Sequence],
    label: str,
    ids: Sequence[str],
    folds: int = 5,
    seed: int = 1,
    threads: int = 4,
) -> dict:
    """Cross-validated mean absolute error of every combination, refit of the best.

    The fold of a row is fixed by its key. The preprocessor is fitted once per fold,
    on the fold's training rows only, and shared by all combinations; folds and
    combinations run side by side. Returns the errors, best parameters, fitted preprocessor and model.
    """
    combos = parameter_grid(grid)
    tagged = stored(df.withColumn("_fold", sample_bucket(ids, seed, folds)), "folds")

    def fold_errors(fold: int) -> list:
        train, held = tagged.where(F.col("_fold") != fold), tagged.where(F.col("_fold") == fold)
        prepared = preprocessor.fit(train)
        ready = prepared.transform(train).select("features", label).persist()
        check = prepared.transform(held).select("features", label).persist()

        def one(params):
            model = fit(ready, label, params)
            return (
                model.transform(check).agg(F.avg(F.abs(F.col(label) - F.col("prediction")))).first()[0]
            )

        try:
            return in_parallel(df.sparkSession, [lambda p=p: one(p) for p in combos], threads)
        finally:
            ready.unpersist()
            check.unpersist()

    by_fold = in_parallel(df.sparkSession, [lambda f=f: fold_errors(f) for f in range(folds)], folds)
    errors = [[e for e in found if e is not None] for found in zip(*by_fold)]
    means = [sum(e) / len(e) for e in errors]
    best = combos[means.index(min(means))]
    prepared = preprocessor.fit(df)
    model = fit(prepared.transform(df).select("features", label), label, best)
    return {
        "errors": list(zip(combos, means)),
        "best": best,
        "preprocessor": prepared,
        "model": model,
    }


def predict(found: dict, df: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """Score rows with the refitted best model."""
    return (
        found["model"]
        .transform(found["preprocessor"].transform(df))
        .select(*keep, F.col("prediction").alias(name))
    )


def feature_importance(df: DataFrame, model, names: Sequence[str], correlations: DataFrame) -> DataFrame:
    """Importance of each feature beside its correlation, most important first."""
    rows = [
        F.struct(F.lit(n).alias("feature"), F.lit(float(v)).alias("importance"))
        for n, v in zip(names, model.featureImportances.toArray())
    ]
    table = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return table.join(correlations, "feature", "left").orderBy(F.desc("importance"), "feature")


def _scaled(df: DataFrame, cols: Sequence[str], name: str, deviation: bool) -> DataFrame:
    """Vector of ``cols`` minus their means, over their sample deviations if asked.

    A constant column becomes 0.
    """
    raw = VectorAssembler(inputCols=list(cols), outputCol="_raw").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol=name, withMean=True, withStd=deviation)
    return scaler.fit(raw).transform(raw).drop("_raw")


def kmeans_feature(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = (5, 15), seed: int = 0, name: str = "cluster"
) -> tuple[DataFrame, list[tuple[int, float]]]:
    """Cluster label of each row for the ``k`` with the best silhouette, on z-scores.

    Also returns the silhouette (squared Euclidean) of every ``k``.
    """
    ready = stored(_scaled(df, cols, "_features", True), "scaled")
    judge = ClusteringEvaluator(featuresCol="_features", predictionCol=name, metricName="silhouette")
    scores, models = [], []
    for k in ks:
        model = KMeans(featuresCol="_features", predictionCol=name, k=k, seed=seed).fit(ready)
        scores.append((k, judge.evaluate(model.transform(ready))))
        models.append(model)
    best = max(range(len(ks)), key=lambda i: scores[i][1])
    return models[best].transform(ready).drop("_features"), scores


def pca(df: DataFrame, cols: Sequence[str], standardized: bool = True) -> tuple[DataFrame, DataFrame, list[float]]:
    """Component scores, loadings (long form) and explained variance ratios.

    The sign of a component is arbitrary; here its first loading is never negative, so
    that repeated runs agree.
    """
    ready = _scaled(df, cols, "_features", standardized)
    model = PCA(k=len(cols), inputCol="_features", outputCol="_raw_scores").fit(ready)
    loadings = model.pc.toArray()
    signs = [-1.0 if x < 0 else 1.0 for x in loadings[0]]
    loadings = loadings * signs
    turned = ElementwiseProduct(
        scalingVec=Vectors.dense(signs), inputCol="_raw_scores", outputCol="_scores"
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(f"PC{j + 1}").alias("component"),
            F.lit(float(loadings[i, j])).alias("loading"),
        )
        for i, c in enumerate(cols)
        for j in range(len(cols))
    ]
    table = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    scores = turned.transform(model.transform(ready)).drop("_features", "_raw_scores")
    return scores, table, model.explainedVariance.toArray().tolist()
