import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.operators.profile import describe_column, null_counts, profile, profile_all
from tallymill.operators.stats import (
    box_stats,
    choose_policy,
    correlation_matrix,
    family_metrics,
    forecast_errors,
    high_corr_features,
    histogram,
    kde,
    mutual_information,
    normal_fit,
)

ROWS = [(1, "a", 2.0), (2, None, 4.5), (None, "b", 9.0), (4, "b" * 200, None), (5, "b", 1.0)]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(ROWS, "n int, t string, v double")


def test_profile_equals_pandas(mixed):
    pdf = pd.DataFrame(ROWS, columns=["n", "t", "v"])
    got = profile(mixed).orderBy("position").toPandas()
    assert got.amount_null.tolist() == pdf.isna().sum().tolist()
    assert got.percent_null.tolist() == pytest.approx((pdf.isna().mean() * 100).tolist())
    assert got.total_cat_entries.tolist() == [0, pdf.t.nunique(), 0]
    both = profile_all({"one": mixed, "two": mixed.select("t")})
    assert both.count() == 4 and both.columns[0] == "dataset_name"
    assert [r.feature_name for r in null_counts(mixed).collect()] == ["n", "t", "v"]


def test_describe_equals_pandas(spark):
    values = [float(v) for v in np.random.default_rng(3).integers(0, 50, 99)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    want = pd.Series(values).describe()
    assert list(describe_column(df, "v").first()) == pytest.approx(want.tolist())


def test_correlation_matrix_is_pairwise_and_survives_constants(spark):
    pdf = pd.DataFrame({"a": [1, 2, 3, 4.0], "b": [2, 1, None, 5.0], "c": [1, 1, 1, 1.0]})
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 1.0), (3.0, None, 1.0), (4.0, 5.0, 1.0)], "a double, b double, c double")
    got = {(r.col_x, r.col_y): r["corr"] for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(pdf.a.corr(pdf.b))
    assert got[("a", "c")] is None and got[("a", "a")] == pytest.approx(1.0)
    chosen = high_corr_features(df, "a", ["a", "b", "c"], 0.1).collect()
    assert [r.feature for r in chosen] == ["b"]


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_numpy(spark, bins):
    values = [float(v) for v in np.random.default_rng(5).integers(0, 100, 500)]
    got = histogram(spark.createDataFrame([(v,) for v in values], "v double"), "v", bins=bins, density=True)
    got = got.orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=bins)
    assert got.n.tolist() == counts.tolist() and got.n.sum() == 500
    np.testing.assert_allclose(got.bin_start, edges[:-1])
    np.testing.assert_allclose(got.density, np.histogram(values, bins=bins, density=True)[0])


def test_histogram_by_width_and_of_one_value(spark):
    df = spark.createDataFrame([(v,) for v in (1, 1, 2, 4, 5)], "v int")
    assert [r.n for r in histogram(df, "v", width=1).orderBy("bin").collect()] == [2, 1, 0, 2]
    one = spark.createDataFrame([(3,), (3,)], "v int")
    assert [r.n for r in histogram(one, "v", bins=2).orderBy("bin").collect()] == [0, 2]
    assert histogram(one.where("v > 9"), "v", bins=2).count() == 0


def test_normal_fit_and_kde(spark):
    values = np.random.default_rng(7).normal(10, 2, 200).round(3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    fit = normal_fit(df, "v", 50).orderBy("i").toPandas()
    mu, sigma = values.mean(), values.std()
    np.testing.assert_allclose(fit.x, np.linspace(values.min(), values.max(), 50))
    np.testing.assert_allclose(
        fit.density, np.exp(-0.5 * ((fit.x - mu) / sigma) ** 2) / (sigma * math.sqrt(2 * math.pi))
    )
    got = kde(df, "v", 40).orderBy("i").toPandas()
    h = values.std(ddof=1) * len(values) ** -0.2
    x = np.linspace(values.min() - 3 * h, values.max() + 3 * h, 40)
    want = np.exp(-0.5 * ((x[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(got.x, x)
    np.testing.assert_allclose(got.density, want)


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0), ("c", None)], "k string, v double")
    got = {r.k: r for r in box_stats(df, ["k"], "v").collect()}
    q1, q3 = np.percentile(values, [25, 75])
    assert (got["a"].q1, got["a"].q3) == pytest.approx((q1, q3))
    assert (got["a"].whisker_low, got["a"].whisker_high, got["a"].outliers) == (1.0, 5.0, 1)
    assert got["b"].median == 7.0 and "c" not in got


def test_mutual_information(spark):
    df = spark.range(1000).select(
        (F.col("id") % 10).cast("double").alias("y"),
        (F.col("id") % 10).cast("string").alias("same"),
        F.lit("x").alias("constant"),
        F.floor(F.col("id") / 100).cast("double").alias("independent"),
    )
    got = {r.feature: r.mi_score for r in mutual_information(df, ["same", "constant", "independent"], "y", 10).collect()}
    assert got["same"] == pytest.approx(math.log(10))
    assert got["constant"] == pytest.approx(0, abs=1e-9) and got["independent"] == pytest.approx(0, abs=1e-9)


def test_forecast_scores_and_policy(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"family": ["a"] * 60 + ["b"] * 60, "store": [1, 2, 3] * 40, "y": rng.normal(10, 3, 120)})
    pdf["base"] = 10.0
    pdf["shift"] = np.where(pdf.family == "a", (pdf.y - 10) * 0.8, 0.0)
    pdf["final"] = pdf.base + pdf["shift"]
    df = spark.createDataFrame(pdf)
    got = {r.family: r for r in choose_policy(family_metrics(df, ["family"], "y", "base", "final", "shift")).collect()}
    a = pdf[pdf.family == "a"]
    assert got["a"].lr_mae == pytest.approx((a.y - a.base).abs().mean())
    assert got["a"].explained_frac == pytest.approx(1 - np.var(a.y - a.final) / np.var(a.y - a.base))
    assert got["a"].policy == "hybrid" and got["b"].policy == "lr"
    errors = {r.family: r for r in forecast_errors(df, "y", {"p": "base"}, ["store"], ["family"]).collect()}
    want = [
        100 * np.mean(2 * (s.y - s.base).abs() / (s.y.abs() + s.base.abs() + 1e-8)) for _, s in a.groupby("store")
    ]
    assert errors["a"].p_smape == pytest.approx(np.mean(want))
