"""Label tables, sparse vectors and the ridge with coefficients per store."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallymill.operators.labels import label_counts, label_index, one_hot_vectors, with_codes
from tallymill.operators.linear import fit_blocked_ridge, predict_blocked
from tallymill.operators.models import TablePreprocessor
from tallymill.operators.reshape import fit_labels


def test_codes_and_vectors(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (2, "a", 10), (3, None, 2), (4, "c c", None), (5, "a", 3)], "i int, k string, n int"
    )
    index = label_index(df, ["k", "n"])
    assert label_counts(index, ["k", "n"]) == {"k": 3, "n": 3}
    got = {r.i: (r.k_code, r.n_code) for r in with_codes(df, index, ["k", "n"]).collect()}
    assert got == {1: (1, 1), 2: (0, 0), 3: (None, 1), 4: (2, None), 5: (0, 2)}  # numbers in text order
    asked = df.unionByName(spark.createDataFrame([(6, "new", 77)], df.schema))
    made = one_hot_vectors(asked, index, {"k": 3, "n": 3}, fill={"k": F.lit("b")})
    rows = {r.i: (list(r.k), list(r.n)) for r in made.select("i", vector_to_array("k_vector").alias("k"), vector_to_array("n_vector").alias("n")).collect()}
    assert rows[2] == ([1, 0, 0], [1, 0, 0]) and rows[3][0] == [0, 1, 0] and rows[6] == ([0, 0, 0], [0, 0, 0])


def test_a_hundred_thousand_labels(spark):
    """No label comes to the driver, and no plan has a column per label."""
    df = spark.range(120_000).select(
        F.col("id").alias("i"), F.concat(F.lit("label "), F.col("id") % 100_000).alias("k"), (F.col("id") % 7).alias("y")
    )
    fitted = TablePreprocessor.of({"one_hot": ["k"], "constant": {"y": 0}}).fit(df)
    out = fitted.transform(df)
    first = out.where("i = 99999").first().features
    assert first.size == 100_001 and first.numNonzeros() == 2
    assert out.select("k", "features").distinct().count() >= 100_000
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    with pytest.raises(ValueError):
        fitted.feature_names()
    with pytest.raises(ValueError):
        fit_labels(df, ["k"])


def wide_ridge(pdf, shared, own, alpha):
    """One column per store and own feature, solved whole."""
    blocks = [((pdf.store == s).to_numpy()[:, None] * pdf[own].to_numpy()) for s in sorted(pdf.store.unique())]
    x = np.hstack([np.ones((len(pdf), 1)), pdf[shared].to_numpy(), *blocks])
    penalty = alpha * np.eye(x.shape[1])
    penalty[0, 0] = 0
    return x @ np.linalg.solve(x.T @ x + penalty, x.T @ pdf.y.to_numpy())


def test_blocked_ridge_equals_one_column_per_store(spark):
    draw = np.random.default_rng(5)
    parts = []
    for g, stores, rows in (("a", 9, 30), ("b", 4, 200), ("c", 1, 25)):
        for s in range(stores):
            n = rows * (4 if s == 0 else 1)
            x = draw.normal(size=(n, 3))
            y = x @ [1, -2, 0.5] + s * 3 + draw.normal(0, 0.1, n) + x[:, 0] * s
            parts.append(pd.DataFrame({"g": g, "store": f"s{s}", "x0": x[:, 0], "x1": x[:, 1], "x2": x[:, 2], "y": y, "one": int(s > 0), "t": x[:, 0] * (s > 0)}))
    pdf = pd.concat(parts, ignore_index=True)
    pdf["i"] = range(len(pdf))
    df = spark.createDataFrame(pdf).repartition(6)
    shared, own = ["x0", "x1", "x2"], ["one", "t"]
    found = fit_blocked_ridge(df, ["g"], "store", shared, own, "y", 2.0)
    got = predict_blocked(df, *found, ["g"], "store", shared, own, "p").toPandas().set_index("i").p
    for _, part in pdf.groupby("g"):
        np.testing.assert_allclose(got.loc[part.i], wide_ridge(part, shared, own, 2.0), atol=1e-8)
    new = df.limit(1).withColumn("store", F.lit("new"))
    assert predict_blocked(new, *found, ["g"], "store", shared, own, "p").first().p is not None


def test_thousands_of_stores(spark):
    """5,000 stores: the system per family stays as small as the shared features."""
    df = spark.range(40_000).select(
        F.lit("f").alias("g"), (F.col("id") % 5000).cast("string").alias("store"),
        (F.col("id") / 5000).cast("int").alias("t"), F.lit(1).alias("one"),
    ).withColumn("y", F.col("t") * 2.0 + F.col("store").cast("int") % 10)
    params, blocks = fit_blocked_ridge(df, ["g"], "store", ["t"], ["one"], "y", 1e-6)
    assert blocks.count() == 5000 and len(params.first().coef) == 1
    error = predict_blocked(df, params, blocks, ["g"], "store", ["t"], ["one"], "p").agg(F.max(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert error < 1e-3
