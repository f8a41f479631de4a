import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.functions.columns import (
    align_columns,
    clip_lower,
    combine_columns,
    count_positive,
    pearson,
    ratio_features,
    ratio_of_sums,
    regex_recode,
)
from tallymill.operators.cleaning import (
    assert_output,
    columns_of_type,
    fill_mode,
    keep_dense_columns,
    low_cardinality_columns,
    map_values,
    rows_at_extreme,
)
from tallymill.operators.cohorts import SEGMENTS


def values(df, col):
    return [r[col] for r in df.collect()]


def test_fill_mode_takes_the_smallest_of_ties(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, "a")], "i int, c string")
    assert values(fill_mode(df, "c").orderBy("i"), "c") == ["b", "a", "a", "b", "a"]
    assert pd.Series(["b", "a", None, "b", "a"]).mode()[0] == "a"


def test_column_choice(spark):
    df = spark.createDataFrame(
        [(1, "x", None, True), (2, "y", 1.0, False), (3, "x", None, True)],
        "n int, t string, d double, b boolean",
    )
    assert columns_of_type(df, "number") == ["n", "d"]
    assert columns_of_type(df, "text") == ["t"]
    assert keep_dense_columns(df, 2).columns == ["n", "t", "b"]
    assert keep_dense_columns(df, 3).columns == df.columns
    assert low_cardinality_columns(df, 3) == ["t"]
    assert low_cardinality_columns(df, 2) == []


def test_low_cardinality_drops_identifiers(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3).cast("string").alias("c"))
    assert low_cardinality_columns(df, 10) == ["c"]


def test_rows_at_extreme_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0), (4, None)], "i int, v double")
    assert sorted(values(rows_at_extreme(df, "v"), "i")) == [2, 3]
    assert values(rows_at_extreme(df, "v", "min"), "i") == [1]


@pytest.mark.parametrize("extra", [0, 300])
def test_map_values_is_null_when_missing(spark, extra):
    mapping = {"a": "x", "b": "y", **{f"k{i}": "z" for i in range(extra)}}
    df = spark.createDataFrame([("a",), ("q",), (None,)], "c string")
    got = {r["c"]: r["m"] for r in map_values(df, "c", mapping, "m").collect()}
    assert got == {"a": "x", "q": None, None: None}


def test_regex_recode_covers_every_code_once(spark):
    codes = [(f"{r}{f}",) for r in range(1, 6) for f in range(1, 6)]
    df = spark.createDataFrame([*codes, ("99",)], "c string")
    got = {r["c"]: r["s"] for r in df.withColumn("s", regex_recode(F.col("c"), SEGMENTS)).collect()}
    want = pd.Series([c for c, in codes]).replace(SEGMENTS, regex=True)
    assert [got[c] for c, in codes] == list(want)
    assert got["99"] == "99"


def test_assert_output(spark):
    good = spark.createDataFrame([(1, 0.0), (2, 3.0)], "i int, v double")
    assert assert_output(good, 2, "v") is good
    for bad, n in ((good, 3), (good.withColumn("v", -F.col("v")), 2), (good.withColumn("v", F.lit(None).cast("double")), 2)):
        with pytest.raises(ValueError):
            assert_output(bad, n, "v")


def test_column_arithmetic(spark):
    df = spark.createDataFrame([(1, 2.0, 0.0), (2, None, 4.0)], "i int, a double, b double")
    assert values(count_positive(df, ["a", "b"], "n").orderBy("i"), "n") == [1, 1]
    out = combine_columns(df, ["a", "b"], "s")
    assert out.columns == ["i", "s"] and values(out.orderBy("i"), "s") == [2.0, None]
    ratios = ratio_features(df, {"r": (["a"], ["b"]), "t": (["a", "b"], None)}).orderBy("i")
    assert values(ratios, "r") == [None, None] and values(ratios, "t") == [2.0, None]
    assert values(df.select(clip_lower(F.col("b") - 1).alias("c"), "i").orderBy("i"), "c") == [0.0, 3.0]
    assert df.agg(ratio_of_sums(F.col("a"), F.col("b")).alias("r")).first()["r"] == 0.5
    aligned = align_columns(df, ["b", "zz"], 0, ["i"])
    assert aligned.columns == ["i", "b", "zz"] and values(aligned, "zz") == [0, 0]


def test_pearson_of_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 1.0, 4.0), (3.0, 1.0, 6.5), (None, 1.0, 1.0)], "a double, b double, c double")
    row = df.agg(pearson(F.col("a"), F.col("b")).alias("ab"), pearson(F.col("a"), F.col("c")).alias("ac")).first()
    assert row["ab"] is None
    assert row["ac"] == pytest.approx(pd.Series([1, 2, 3]).corr(pd.Series([2, 4, 6.5])))
