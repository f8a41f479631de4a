"""Results that must not depend on how long, wide or high the data are."""

from __future__ import annotations

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.operators.cleaning import low_cardinality_columns, map_values
from tallymill.operators.cohorts import cohort_activity, retention
from tallymill.operators.models import TablePreprocessor, kmeans_feature
from tallymill.operators.series import fill_panel
from tallymill.operators.stats import histograms, pacf


def yule_walker(x, nlags):
    x = np.asarray(x, float) - np.mean(x)
    gamma = np.array([(x[k:] * x[: len(x) - k]).sum() / len(x) for k in range(nlags + 1)])
    out = [1.0]
    for k in range(1, nlags + 1):
        square = np.array([[gamma[abs(i - j)] for j in range(k)] for i in range(k)])
        out.append(np.linalg.solve(square, gamma[1 : k + 1])[-1])
    return out


@pytest.mark.parametrize("level", [0.0, 1e6, 1e9])
def test_partial_autocorrelation_at_any_level(spark, level):
    draw, x = np.random.default_rng(3), [0.0]
    for _ in range(399):
        x.append(0.6 * x[-1] + draw.normal())
    rows = [("a", i, level + v) for i, v in enumerate(x)] + [("flat", i, level) for i in range(5)] + [(None, 0, 1.0)]
    df = spark.createDataFrame(rows, "k string, i int, v double").select(
        "k", F.date_add(F.lit("2000-01-01"), F.col("i")).alias("i"), "v"
    )
    got = {(r["k"], r["lag"]): r["pacf"] for r in pacf(df, ["k"], ["i"], "v", 6).collect()}
    assert np.allclose([got["a", k] for k in range(7)], yule_walker(x, 6), atol=1e-6)
    assert all(np.isnan(got["flat", k]) for k in range(7)) and len(got) == 14


def test_cohorts_over_thirty_quarters(spark):
    rows = [(1, datetime.datetime(1990 + q // 4, 1 + 3 * (q % 4), 2)) for q in range(30)]
    df = spark.createDataFrame(rows, "c int, ts timestamp")
    got = retention(cohort_activity(df, "c", "ts")).collect()
    assert sorted(r["age"] for r in got) == list(range(30)) and {r["retention"] for r in got} == {100.0}


def test_target_means_of_any_type_and_number(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 2 == 0).alias("flag"),
        ((F.col("id") % 20_000) * 1e10).alias("big"),
        F.when(F.col("id") % 2 == 0, 3.0).otherwise(9.0).alias("y"),
    )
    spec = {"target": {"columns": ["flag", "big"], "label": "y", "m": 0.0}}
    fitted = TablePreprocessor.of(spec).fit(df)
    out = fitted.encode(df, ["flag", "y"])
    assert out.where("abs(flag_mean - y) > 1e-9 or abs(big_mean - y) > 1e-9").count() == 0
    unseen = spark.createDataFrame([(None, 5.0, 0.0)], "flag boolean, big double, y double")
    assert fitted.encode(unseen).first().asDict() == {"flag_mean": 6.0, "big_mean": 6.0}
    assert fitted.transform(df).columns == [*df.columns, "features"]


def test_long_vectors_are_clustered_whole(spark):
    rows = [(i, [0.0] * 99 + [float(100 * (i % 2))]) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, v array<double>")
    from pyspark.ml.functions import array_to_vector

    out, _ = kmeans_feature(df.select("i", array_to_vector("v").alias("v")), ["v"], (2,))
    assert len({(r["i"] % 2, r["cluster"]) for r in out.collect()}) == 2


def test_rows_without_a_key_belong_to_no_panel_series(spark):
    day = datetime.date(2000, 1, 1)
    rows = [("f", "s", day, 1.0), (None, "s", day + datetime.timedelta(1), 7.0), ("f", "s", day + datetime.timedelta(2), 2.0)]
    df = spark.createDataFrame(rows, "f string, s string, d date, v double")
    got = [(r["f"], r["v"]) for r in fill_panel(df, ["f", "s"], "d", "v").orderBy("d").collect()]
    assert got == [("f", 1.0), ("f", 0.0), ("f", 2.0)]


def test_histograms_of_several_columns(spark):
    df = spark.createDataFrame([(0.0, 5.0, None), (1.0, 5.0, None), (4.0, None, None)], "a double, b double, c double")
    got = {(r["column_name"], r["bin"]): r["n"] for r in histograms(df, ["a", "b", "c"], 4).collect()}
    assert [got["a", i] for i in range(4)] == [1, 1, 0, 1]
    assert [got["b", i] for i in range(4)] == [0, 0, 2, 0] and ("c", 0) not in got


def test_lookup_and_cardinality(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (None, "y")], "k int, t string")
    assert {r["v"] for r in map_values(df, "k", {}, "v", "int").collect()} == {None}
    assert map_values(df, "k", {1: 5}, "v", "int").schema["v"].dataType.simpleString() == "int"
    assert low_cardinality_columns(df, 3) == ["t"] and low_cardinality_columns(df, 2) == []
