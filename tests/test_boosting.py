"""Boosted trees of many groups: against MLlib, against themselves in chunks, and their jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tallymill.operators.boosting import best_rounds, fit_boosted, lay_out, predict_boosted

FEATURES = ["a", "b", "c"]


def table(spark, groups, rows, seed=0):
    draw = np.random.default_rng(seed)
    parts = []
    for g in range(groups):
        n = rows * 5 if g == 0 else rows  # one hot group
        x = pd.DataFrame({"a": draw.integers(0, 9, n), "b": draw.integers(0, 20, n) / 4, "c": draw.integers(0, 2, n)})
        y = np.where(x.a > 2 + g % 5, 10.0, 0.0) + x.b * (g % 3) + 4 * x.c + draw.normal(0, 0.5, n)
        parts.append(x.assign(g=f"g{g}", i=range(n), y=y))
    return spark.createDataFrame(pd.concat(parts))


def test_one_tree_equals_mllib_per_group(spark):
    df = table(spark, 4, 150).cache()
    for depth in (1, 3):
        setting = {"maxDepth": depth, "maxIter": 1, "stepSize": 1.0, "minInstancesPerNode": 3}
        models = best_rounds(fit_boosted(lay_out(df, ["g"], FEATURES, "y", ["i"]), ["g"], [setting]), ["g"])
        got = predict_boosted(df, models, ["g"], FEATURES, "p").toPandas().set_index(["g", "i"]).p
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
        for g in ("g0", "g1", "g2", "g3"):
            mine = vectors.where(F.col("g") == g)
            tree = DecisionTreeRegressor(labelCol="y", maxDepth=depth, minInstancesPerNode=3).fit(mine)
            want = tree.transform(mine).toPandas().set_index(["g", "i"]).prediction
            np.testing.assert_allclose(got.loc[want.index], want)
            first = models.where(F.col("g") == g).first().trees
            top = next(n for n in first if n.node == 1 and n.feature >= 0)
            root = tree._java_obj.rootNode().split()
            assert top.feature == root.featureIndex() and top.threshold == pytest.approx(root.threshold())


def test_chunks_and_levels_give_the_same_trees(spark):
    df = table(spark, 3, 120).withColumn("held", F.col("i") % 4 == 0)
    settings = [
        {"maxDepth": 2, "maxIter": 4, "stepSize": 0.3, "subsamplingRate": 0.7, "featureRate": 0.7},
        {"maxDepth": 3, "maxIter": 3, "stepSize": 0.5, "minInstancesPerNode": 5, "l2": 1.0},
    ]
    found = []
    for rows in (10_000, 100):
        chunks = lay_out(df, ["g"], FEATURES, "y", ["i"], F.col("held"), chunk_rows=rows)
        models = fit_boosted(chunks, ["g"], settings)
        assert models.count() == 6
        pick = best_rounds(models, ["g"])
        out = predict_boosted(df, pick, ["g"], FEATURES, "p", rows=50).orderBy("g", "i").toPandas()
        errors = {(r.g, r.setting): list(r.errors) for r in models.collect()}
        found.append((out, errors, {r.g: (r.setting, r.rounds) for r in pick.collect()}))
    assert chunks.where("chunks > 1").count() > 0
    (a, ea, pa), (b, eb, pb) = found
    np.testing.assert_allclose(a.p, b.p)
    assert pa == pb and ea.keys() == eb.keys()
    for key in ea:
        np.testing.assert_allclose(ea[key], eb[key])
    held = a[a.held]
    assert np.abs(held.p - held.y).mean() < 0.5 * np.abs(held.y - held.y.mean()).mean()


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    run()
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return count


def test_jobs_do_not_grow_with_the_groups(spark):
    """2,000 groups take as many jobs as 20, whether they fit a chunk or not."""
    setting = {"maxDepth": 1, "maxIter": 2}

    def run(groups, rows):
        df = (
            spark.range(groups * 30)
            .withColumn("g", (F.col("id") % groups).cast("string"))
            .select("id", "g", F.pmod(F.hash("id"), F.lit(7)).alias("a"), F.pmod(F.xxhash64("id"), F.lit(5)).alias("b"))
            .withColumn("y", F.col("a") * 2.0 + F.col("b"))
        )
        chunks = lay_out(df, ["g"], ["a", "b"], "y", ["id"], chunk_rows=rows)
        models = best_rounds(fit_boosted(chunks, ["g"], [setting]), ["g"])
        assert models.count() == groups

    def jobs(groups, rows):
        return jobs_of(spark, f"boost-{groups}-{rows}", lambda: run(groups, rows))

    assert jobs(2000, 10_000) <= jobs(20, 10_000) + 2
    assert jobs(200, 20) <= jobs(20, 20) + 2


def test_odd_rows(spark):
    rows = [("x", 1, None, 2.0), ("x", 2, 1.0, None), ("x", 3, float("nan"), 3.0), (None, 4, 1.0, 1.0), ("y", 5, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, i int, a double, y double")
    chunks = lay_out(df, ["g"], ["a"], "y", ["i"])
    models = best_rounds(fit_boosted(chunks, ["g"], [{"maxIter": 2, "maxDepth": 2}]), ["g"])
    got = {r.i: r.p for r in predict_boosted(df, models, ["g"], ["a"], "p").collect()}
    assert got == {1: 2.5, 2: 2.5, 3: 2.5, 4: None, 5: 4.0}
    none = fit_boosted(lay_out(df.limit(0), ["g"], ["a"], "y", ["i"]), ["g"], [{}])
    assert none.count() == 0
    assert predict_boosted(df, best_rounds(none, ["g"]), ["g"], ["a"], "p").where("p is not null").count() == 0
