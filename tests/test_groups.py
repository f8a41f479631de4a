import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymill.operators.aggregates import (
    complete_categories,
    multi_agg,
    nested_average,
    ordered_path,
    share,
    value_counts,
    yoy_growth,
)
from tallymill.operators.quantiles import exact_quantiles
from tallymill.operators.ranking import global_rank, head_tail, order_by_labels, ordered_blocks, quantile_score
from tallymill.operators.reshape import (
    explode_list,
    fit_labels,
    interaction,
    one_hot,
    pivot_table,
    unpivot,
)

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_yoy_growth_needs_both_periods_and_a_strict_delta(spark):
    rows = [("a", 1)] * 2 + [("a", 2)] * 5 + [("b", 1)] * 2 + [("b", 2)] * 4 + [("c", 2)] * 9 + [(None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, y int")
    got = yoy_growth(df, ["k"], F.col("y"), 1, 2, 2).collect()
    assert [(r.k, r.n_before, r.n_after, r.increase_percent) for r in got] == [("a", 2, 5, 150.0)]


def test_nested_average_ignores_null_totals(spark):
    # Visitor 1 bought in one visit, visitor 2 never (null total), visitor 3 bought twice.
    rows = [(1, 1, 2, 1), (1, 2, 3, None), (2, 1, 9, None), (3, 1, 4, 2)]
    df = spark.createDataFrame(rows, "v int, s int, views int, buys int")
    out = nested_average(
        df,
        [(["v", "s"], {"views": F.sum("views"), "buys": F.max("buys")}),
         (["v"], {"views": F.sum("views"), "buys": F.sum("buys")})],
        F.col("buys") >= 1,
        {"avg_views": F.try_divide(F.sum("views"), F.count(F.lit(1)))},
    )
    assert out.first()[0] == 4.5


def test_ordered_path_equals_one_sort_and_handles_nulls(spark):
    rows = [("a", i, f"p{i % 7}" if i % 5 else None) for i in range(300)] + [("b", 1, None)]
    df = spark.createDataFrame(rows, "k string, n int, p string")
    got = {r.k: r.path for r in ordered_path(df, ["k"], "p", ["n"], F.floor(F.col("n") / 16)).collect()}
    assert got["a"] == "->".join(p for _, _, p in rows[:300] if p)
    assert got["b"] == ""


def test_counts_and_shares(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "c string")
    assert [(r.c, r["count"]) for r in value_counts(df, "c").collect()] == [("x", 2), ("y", 1)]
    assert {r.c: r.share for r in share(df, ["c"]).collect()} == {"x": 0.5, "y": 0.25}
    full = complete_categories(value_counts(df, "c"), "c", ["z", "x"], "count")
    assert [(r.c, r["count"]) for r in full.collect()] == [("z", 0), ("x", 2)]


def test_multi_agg_matches_pandas(spark):
    pdf = pd.DataFrame({"k": ["a", "a", "b", None], "v": [1.0, 3.0, 5.0, 9.0]})
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 9.0)], "k string, v double")
    got = multi_agg(df, ["k"], ["v"], ["mean", "count", "sum"]).orderBy("k").toPandas()
    want = pdf.groupby("k")["v"].agg(["mean", "count", "sum"]).reset_index()
    assert got.to_numpy().tolist() == want.to_numpy().tolist()


def test_pivot_explode_unpivot(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("b", 1, 5.0)], "k string, c int, v double")
    wide = pivot_table(df, ["k"], "c", F.sum("v"), [1, 2], fill=0, prefix="c").orderBy("k")
    assert [tuple(r) for r in wide.collect()] == [("a", 2.0, 3.0), ("b", 5.0, 0.0)]
    assert unpivot(wide, ["k"], ["c1", "c2"]).count() == 4
    lists = spark.createDataFrame([(1, "x, y"), (2, None), (3, "z")], "i int, l string")
    assert sorted((r.i, r.e) for r in explode_list(lists, "l", "e").collect() if r.e) == [(1, "x"), (1, "y"), (3, "z")]
    assert explode_list(lists, "l", "e").where("i = 2").first().e is None
    piped = spark.createDataFrame([("a.b|c",)], "l string")
    assert [r.e for r in explode_list(piped, "l", "e", "|").collect()] == ["a.b", "c"]


def test_one_hot_and_interaction(spark):
    train = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "k string, n int")
    test = spark.createDataFrame([("b", 5), ("zz", 6), (None, 7)], "k string, n int")
    labels = fit_labels(train, ["k"])
    out = one_hot(test, ["k"], drop_first=True, labels=labels).orderBy("n")
    assert [(r.k_b, r.k_c) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]
    crossed = interaction(test, "k", "n", labels["k"]).orderBy("n").collect()
    assert [(r.k_a, r.k_b) for r in crossed] == [(0, 5), (0, 0), (0, 0)]
    many = spark.range(1500).selectExpr("id as k", "'A B' as t").unionByName(spark.range(1).selectExpr("-1L as k", "'A_B' as t"))
    found = fit_labels(many, ["k", "t"])
    assert len(found["k"]) == 1501
    clash = one_hot(many.where("k <= 0"), ["t"], labels=found).orderBy("k").collect()
    assert [r.asDict() for r in clash] == [{"k": -1, "t_A_B": 0, "t_A_B_1": 1}, {"k": 0, "t_A_B": 1, "t_A_B_1": 0}]


def test_head_tail_and_label_order(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "v int")
    got = sorted((r.end, r.v) for r in head_tail(df, ["v"], 2).collect())
    assert got == [("head", 0), ("head", 1), ("tail", 8), ("tail", 9)]
    days = spark.createDataFrame([("Tue",), ("Mon",), ("???",)], "d string")
    assert [r.d for r in order_by_labels(days, "d", ["Mon", "Tue"]).collect()] == ["Mon", "Tue", "???"]


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.2, 0.5, 0.83, 1.0]
    for keys in ([], ["k"]):
        pdf = pd.DataFrame(rows, columns=["k", "v"])
        groups = pdf.groupby("k")["v"] if keys else [("", pdf["v"])]
        want = {k: [v.quantile(p) for p in probs] for k, v in groups}
        for r in exact_quantiles(df, "v", probs, keys).collect():
            key = r["k"] if keys else ""
            assert [r[f"q{i}"] for i in range(5)] == pytest.approx(want.pop(key), rel=1e-9, abs=1e-6)
        assert not want


def test_exact_quantiles_with_a_rough_sketch_and_a_hot_group(spark):
    # One group holds most rows and one value most of those; the sketch is very rough.
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("v"),
    )
    pdf = df.toPandas()
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["k"], accuracy=5).toPandas().set_index("k")
    for key, part in pdf.groupby("k"):
        assert got.loc[key].tolist() == pytest.approx([part.v.quantile(p) for p in (0.1, 0.5, 0.9)])


def test_a_hot_key_is_joined_in_pieces(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("k"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(100_000))).alias("ts"), "id", F.col("id").cast("string").alias("v"),
    )
    got = {r.k: r.path for r in ordered_path(df, ["k"], "v", ["ts", "id"], rows=100).collect()}
    want = df.toPandas().sort_values(["ts", "id"]).groupby("k").v.agg("->".join).to_dict()
    assert got == want


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, "a")], "v double, k string")
    assert exact_quantiles(df, "v", [0.5], ["k"]).count() == 0
    assert exact_quantiles(df, "v", [0.5]).first().q0 is None


@pytest.mark.parametrize("n", [1, 13, 257, 5000])
def test_global_rank_is_the_sorted_position(spark, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.hash("id"), 50)).alias("f"))
    got = global_rank(df, ["f", "id"]).toPandas().sort_values(["f", "id"])
    assert got["rank"].tolist() == list(range(1, n + 1))


def test_global_rank_cuts_blocks_until_none_is_large(spark):
    """Two levels of splitters: no block above its bound, and the same ranks."""
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.hash("id"), 50)).alias("f"))
    blocks = ordered_blocks(df, ["f", "id"], rows=40).groupBy("_block").count().toPandas()
    assert blocks["count"].max() <= 40 and len(blocks) > 256
    got = global_rank(df, ["f", "id"], rows=40).toPandas().sort_values(["f", "id"])
    assert got["rank"].tolist() == list(range(1, 30001))


def test_global_rank_puts_no_table_in_one_task(spark):
    df = spark.range(20000).select("id", F.lit(1).alias("f"))
    blocks = global_rank(df, ["f", "id"])
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    # Only the block counts are numbered without a partition.
    assert plan.count("Window [row_number()") == 1 and "[_block" in plan


@pytest.mark.parametrize("n", [5, 13, 200])
def test_quantile_score_equals_qcut(spark, n):
    values = [(i, float((i * 7919) % 1009)) for i in range(n)]
    df = spark.createDataFrame(values, "i int, v double")
    got = quantile_score(df, "v", [5, 4, 3, 2, 1], "s").orderBy("i").toPandas()
    want = pd.qcut(pd.Series([v for _, v in values]), 5, labels=[5, 4, 3, 2, 1])
    assert got.s.tolist() == want.astype(int).tolist()


@pytest.mark.parametrize("n", [5, 13, 300])
def test_quantile_score_by_rank_equals_qcut_of_first_rank(spark, n):
    df = spark.createDataFrame([(i, i % 4) for i in range(n)], "i int, f int")
    got = quantile_score(df, "f", [1, 2, 3, 4, 5], "s", tie="i").orderBy("i").toPandas()
    rank = pd.Series([i % 4 for i in range(n)]).rank(method="first")
    assert got.s.tolist() == pd.qcut(rank, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_quantile_score_raises_on_repeated_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "v double")
    with pytest.raises(Exception, match="edges repeat"):
        quantile_score(df, "v", [1, 2, 3, 4, 5], "s").collect()
