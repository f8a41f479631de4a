import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymill.operators.encode import (
    factorize,
    impute,
    m_estimate_encode,
    ordinal_encode,
    sample_bucket,
    standardize,
    target_encoding,
)
from tallymill.operators.models import (
    TablePreprocessor,
    TablePreprocessorModel,
    feature_importance,
    fit_boosted,
    fit_forest,
    grid_search,
    kmeans_feature,
    pca,
    predict,
)
from tallymill.operators.stats import high_corr_features

GRADES = ["Po", "Fa", "TA", "Gd", "Ex"]


def test_impute_uses_the_training_rows(spark):
    train = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, "b"), (7.0, None)], "v double, t string")
    test = spark.createDataFrame([(None, None, None)], "v double, t string, z double")
    out = impute(test, {"v": "median", "t": "most_frequent", "z": ("constant", 0.0)}, train).first()
    assert (out.v, out.t, out.z) == (3.0, "b", 0.0)
    with pytest.raises(ValueError):
        impute(test, {"v": "guess"})


def test_ordinal_encode(spark):
    df = spark.createDataFrame([("Po",), ("Ex",), (None,)], "g string")
    assert [r.g for r in ordinal_encode(df, ["g"], GRADES).collect()] == [0, 4, None]
    odd = spark.createDataFrame([("??",)], "g string")
    assert ordinal_encode(odd, ["g"], GRADES, strict=False).first().g is None
    with pytest.raises(Exception, match="unknown grade"):
        ordinal_encode(odd, ["g"], GRADES).collect()


def test_factorize_is_dense_and_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "t string")
    got = {(r.t, r.code) for r in factorize(df, "t", "code").collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2), (None, -1)}
    many = spark.range(3000).select(F.concat(F.lit("id"), F.col("id")).alias("t"))
    codes = factorize(many, "t", "code").toPandas().sort_values("t")
    assert codes.code.tolist() == list(range(3000))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-100, 100)), min_size=1, max_size=20))
def test_m_estimate(spark, rows):
    train = spark.createDataFrame(rows, "c string, y double")
    test = spark.createDataFrame([("a",), ("b",), ("unseen",), (None,)], "c string")
    pdf = pd.DataFrame(rows, columns=["c", "y"])
    prior = pdf.y.mean()
    want = {c: (s.sum() + 5 * prior) / (len(s) + 5) for c, s in pdf.groupby("c").y}
    for r in m_estimate_encode(train, test, "c", "y", "e").collect():
        assert r.e == pytest.approx(want.get(r.c, prior))


def test_target_encoding_splits_by_key(spark):
    df = spark.range(1000).select("id", (F.col("id") % 4).cast("string").alias("c"), F.col("id").cast("double").alias("y"))
    marked = df.withColumn("held", sample_bucket(["id"], 3) < 20).toPandas()
    assert 130 < marked.held.sum() < 270
    got = target_encoding(df, "c", "y", ["id"], 3).toPandas()
    assert sorted(got.id) == sorted(marked.id[~marked.held])
    held = marked[marked.held]
    prior = held.y.mean()
    want = {c: (s.sum() + 5 * prior) / (len(s) + 5) for c, s in held.groupby("c").y}
    np.testing.assert_allclose(got.c_enc, got.c.map(want))


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (6.0, 3.0)], "a double, b double")
    out = standardize(df, ["a", "b"]).toPandas()
    a = pd.Series([1.0, 2.0, 6.0])
    assert sorted(out.a) == pytest.approx(sorted((a - a.mean()) / a.std()))
    assert out.b.isna().all()


@pytest.fixture(scope="module")
def houses(spark):
    rng = np.random.default_rng(0)
    n = 240
    pdf = pd.DataFrame({"id": range(n), "size": rng.uniform(1, 10, n), "rooms": rng.integers(1, 6, n).astype(float)})
    pdf["kind"] = rng.choice(["a", "b", "c"], n)
    pdf["grade"] = rng.choice(GRADES, n)
    pdf["place"] = rng.choice([f"p{i}" for i in range(6)], n)
    pdf["price"] = 10 * pdf["size"] + 5 * pdf.rooms + pdf.grade.map(GRADES.index) * 3 + rng.normal(0, 1, n)
    rows = [tuple(None if i % 9 == 0 and c in ("size", "kind", "grade") else v for c, v in zip(pdf, row))
            for i, row in enumerate(pdf.itertuples(index=False))]
    return spark.createDataFrame(rows, "id long, size double, rooms double, kind string, grade string, place string, price double")


SPEC = {
    "median": ["size"],
    "constant": {"rooms": 0},
    "one_hot": ["kind"],
    "ordinal": {"grade": {"grades": GRADES, "fill": None}},
    "target": {"columns": ["place"], "label": "price", "m": 5.0},
}


def test_preprocessor_equals_pandas_and_survives_storage(spark, houses, tmp_path):
    fitted = TablePreprocessor.of(SPEC).fit(houses)
    fitted.write().save(str(tmp_path / "pre"))
    fitted = TablePreprocessorModel.load(str(tmp_path / "pre"))
    got = fitted.encode(houses, ["id"]).toPandas().sort_values("id").reset_index(drop=True)
    pdf = houses.toPandas().sort_values("id").reset_index(drop=True)
    np.testing.assert_allclose(got["size"], pdf["size"].fillna(pdf["size"].median()))
    kind = pdf.kind.fillna(pdf.kind.mode()[0])
    for k in "abc":
        assert got[f"kind_{k}"].tolist() == (kind == k).astype(float).tolist()
    grade = pdf.grade.fillna(pdf.grade.mode()[0]).map(GRADES.index)
    assert got.grade_grade.tolist() == grade.tolist()
    prior = pdf.price.mean()
    means = pdf.groupby("place").price.apply(lambda s: (s.sum() + 5 * prior) / (len(s) + 5))
    np.testing.assert_allclose(got.place_mean, pdf.place.map(means))
    unseen = spark.createDataFrame([(None, None, "zz", "Ex", "zz")], "size double, rooms double, kind string, grade string, place string")
    row = fitted.encode(unseen).first()
    assert (row.kind_a, row.kind_b, row.kind_c, row.rooms) == (0.0, 0.0, 0.0, 0.0)
    assert row.place_mean == pytest.approx(prior)
    assert fitted.transform(houses).first().features.size == len(fitted.feature_names())


@pytest.mark.parametrize("fit,grid", [
    (fit_forest, {"numTrees": [8], "minInstancesPerNode": [2, 60]}),
    (fit_boosted, {"maxIter": [6], "maxDepth": [1, 4]}),
])
def test_grid_search_beats_the_mean(houses, fit, grid):
    found = grid_search(houses, TablePreprocessor.of(SPEC), fit, grid, "price", ["id"], folds=3)
    assert len(found["errors"]) == 2
    assert found["best"] == min(found["errors"], key=lambda e: e[1])[0]
    scored = predict(found, houses, ["id", "price"], "p").toPandas()
    assert len(scored) == 240
    naive = (scored.price - scored.price.mean()).abs().mean()
    assert min(e for _, e in found["errors"]) < 0.6 * naive
    names = found["preprocessor"].feature_names()
    table = found["preprocessor"].encode(houses, ["price"])
    importance = feature_importance(houses, found["model"], names, high_corr_features(table, "price", names, -1.0))
    rows = importance.collect()
    assert rows[0].feature == "size" and len(rows) == len(names)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)


def test_kmeans_finds_separate_groups(spark):
    rng = np.random.default_rng(2)
    rows = [(g, *(float(v) for v in rng.normal(g * 10, 0.5, 2)), 1.0) for g in range(3) for _ in range(30)]
    df = spark.createDataFrame(rows, "g int, a double, b double, constant double")
    out, scores = kmeans_feature(df, ["a", "b", "constant"], (2, 3), seed=0)
    assert max(scores, key=lambda s: s[1])[0] == 3
    pdf = out.toPandas()
    assert pdf.groupby("g").cluster.nunique().tolist() == [1, 1, 1] and pdf.cluster.nunique() == 3


def test_pca_equals_numpy_up_to_sign(spark):
    x = np.random.default_rng(4).normal(size=(80, 3)) @ np.array([[2, 1, 0], [0, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    scores, loadings, explained = pca(df, ["a", "b", "c"])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = values.argsort()[::-1]
    np.testing.assert_allclose(explained, values[order] / values.sum(), rtol=1e-8)
    wide = loadings.toPandas().pivot(index="feature", columns="component", values="loading").to_numpy()
    np.testing.assert_allclose(np.abs(wide), np.abs(vectors[:, order]), atol=1e-8)
    got = np.array([r._scores.toArray() for r in scores.select("_scores").collect()])
    np.testing.assert_allclose(np.abs(got), np.abs(z @ vectors[:, order]), atol=1e-8)
