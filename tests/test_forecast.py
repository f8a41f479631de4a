import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.functions.calendar import seasonal_terms
from tallymill.operators.forecast import (
    combine_forecast,
    diagnose,
    load_models,
    parameter_grid,
    predict_all,
    save_models,
    seasonal_fit_predict,
    time_split,
    train_all,
)
from tallymill.operators.linear import fit_linear, fit_ridge, predict_linear

START = dt.date(2015, 1, 1)


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [0.0, 4.0])
def test_ridge_equals_the_closed_form_per_group(spark, alpha):
    rng = np.random.default_rng(0)
    # One group holds most rows, one is constant.
    pdf = pd.DataFrame({"g": ["hot"] * 900 + ["b"] * 60 + ["flat"] * 40})
    x = rng.normal(size=(1000, 3))
    pdf[["x0", "x1", "x2"]] = x
    pdf["y"] = x @ [1.0, -2.0, 0.5] + 7 + rng.normal(0, 0.1, 1000)
    pdf.loc[pdf.g == "flat", "y"] = 3.0
    df = spark.createDataFrame(pdf).repartition(7)
    features = ["x0", "x1", "x2"]
    params = fit_linear(df, ["g"], features, "y", alpha=alpha)
    got = {r.g: r for r in params.collect()}
    for g, part in pdf.groupby("g"):
        w, b = ridge(part[features].to_numpy(), part.y.to_numpy(), alpha)
        np.testing.assert_allclose(got[g].coef, w, atol=1e-8)
        assert got[g].intercept == pytest.approx(b) and got[g].n == len(part)
    scored = predict_linear(df, params, ["g"], features, "p").toPandas()
    part = scored[scored.g == "b"]
    np.testing.assert_allclose(part.p, part[features].to_numpy() @ got["b"].coef + got["b"].intercept)


def test_seasonal_forecast_recovers_a_known_rule(spark):
    days = [START + dt.timedelta(days=i) for i in range(365)]

    def rule(k, i, d):
        return k * (5 + 0.01 * (i + 1) + 2 * (d.weekday() == 5) + math.sin(2 * math.pi * (d.day - 1) / month_days(d)))

    def month_days(d):
        return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1).__sub__(dt.timedelta(days=1)).day

    rows = [(f"s{k}", d, rule(k, i, d)) for k in (1, 2) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = seasonal_fit_predict(df, ["k"], "date", "v", 16).toPandas()
    assert len(got) == 32
    for r in got.itertuples():
        i = (r.date - START).days
        assert r.prediction == pytest.approx(rule(int(r.k[1]), i, r.date), abs=1e-6)
    assert len(seasonal_terms(F.col("date"), F.col("date"))) == 17


def test_combine_and_split(spark):
    df = spark.createDataFrame([(START, -3.0, 1.0, 1), (dt.date(2016, 1, 1), 4.0, 1.0, 0)], "d date, b double, c double, g int")
    before, after = time_split(df, "d", "2016-01-01")
    assert before.count() == after.count() == 1
    made = df.select(
        combine_forecast(F.col("b"), F.col("c")).alias("clipped"),
        combine_forecast(F.col("b"), F.col("c"), F.col("g"), floor=None).alias("gated"),
    ).collect()
    assert [(r.clipped, r.gated) for r in made] == [(0.0, -2.0), (5.0, 0.0)]
    assert len(parameter_grid({"a": [1, 2], "b": [3, 4, 5]})) == 6


@pytest.fixture(scope="module")
def panel(spark):
    """Family 'line' follows a linear rule, family 'jumpy' depends on yesterday."""
    rng = np.random.default_rng(1)
    rows = []
    for store in ("1", "2"):
        value = 5.0
        for i in range(500):
            day = START + dt.timedelta(days=i)
            rows.append(("line", store, day, 20 + 0.05 * i * int(store) + 3 * (day.weekday() == 5)))
            value = 40.0 if value < 20 else 5.0 + rng.uniform(0, 1)
            rows.append(("jumpy", store, day, value))
    return spark.createDataFrame(rows, "family string, store string, date date, sales double").persist()


GRID = {"maxDepth": [2], "stepSize": [0.3], "maxIter": [8], "minInstancesPerNode": [3]}


def test_diagnose_finds_where_the_correction_helps(panel):
    scored, metrics, best = diagnose(panel, "2016-02-01", "2015-12-01", (1, 7), (7,), alpha=0.01, grid=GRID)
    got = {r.family: r for r in metrics.collect()}
    assert got["jumpy"].policy == "hybrid" and got["jumpy"].mae_improvement_pct > 40
    assert got["line"].policy == "lr" or got["line"].lr_mae < 0.5
    assert got["line"].store_slope_variance == pytest.approx(0.0, abs=1e-6)
    assert set(best) == {"line", "jumpy"} and best["jumpy"]["maxDepth"] == 2
    assert scored.where(F.col("hybrid_pred").isNull()).count() == 0


def test_train_save_load_predict(spark, panel, tmp_path):
    train, future = time_split(panel, "date", "2016-05-01")
    params = {"maxDepth": 2, "maxIter": 4}
    models = train_all(train, {"line": "lr", "jumpy": "hybrid"}, {"jumpy": params}, alpha=0.01)
    asked = future.drop("sales")
    direct = predict_all(asked, models).toPandas()
    save_models(models, str(tmp_path / "m"))
    loaded = load_models(spark, str(tmp_path / "m"))
    assert loaded.spec == models.spec and list(loaded.trees) == ["jumpy"]
    again = predict_all(asked, loaded).toPandas()
    order = ["family", "store", "date"]
    a, b = direct.sort_values(order), again.sort_values(order)
    np.testing.assert_allclose(a.sales, b.sales)
    assert len(a) == future.count() and (a.sales >= 0).all()
    truth = future.toPandas().sort_values(order)
    line = (truth.family == "line").to_numpy()
    assert np.abs(a.sales.to_numpy()[line] - truth.sales.to_numpy()[line]).max() < 1.0


def test_a_family_without_trees_is_only_the_ridge(panel):
    models = train_all(panel, {"line": "lr", "jumpy": "lr"}, {})
    assert models.trees == {}
    assert {r.policy for r in models.params.collect()} == {"lr"}
    out = fit_ridge(panel.withColumn("x", F.dayofyear("date")), ["family"], ["x"], "sales")
    assert out.count() == 2
