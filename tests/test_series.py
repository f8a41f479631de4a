import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.operators.cuts import long_groups, with_blocks
from tallymill.operators.series import (
    FeatureSpec,
    PanelColumns,
    build_features,
    build_forecast_features,
    date_index,
    fill_panel,
    fit_spec,
)
from tallymill.operators.stats import pacf, series_sanity
from tallymill.operators.windows import (
    add_lags,
    add_rolling_means,
    autocorr,
    centered_mean,
    group_stat_feature,
    lag_of,
    period_index,
    series_window,
    time_index,
    top_n_per_group,
    trailing_mean,
    with_positions,
)

START = dt.date(2015, 12, 20)


def panel(hot=400, short=3):
    """One long series, one short one, zeros and a missing day."""
    rows = []
    for store, n in (("hot", hot), ("short", short), ("one", 1)):
        for i in range(n):
            if store == "hot" and i == 11:
                continue
            rows.append((store, START + dt.timedelta(days=i), float((i * 37) % 11 if i % 4 else 0)))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(panel(), "store string, date date, sales double").repartition(3)


@pytest.fixture(scope="module")
def pdf():
    return pd.DataFrame(panel(), columns=["store", "date", "sales"]).sort_values(["store", "date"])


def aligned(df, col):
    return df.toPandas().sort_values(["store", "date"])[col].to_numpy()


@pytest.mark.parametrize("chunk", [8, 64, 4096])
def test_lags_and_rolling_equal_pandas(frame, pdf, chunk):
    grouped = pdf.groupby("store")["sales"]
    lags = add_lags(frame, ["store"], ["date"], "sales", [1, 7], chunk=chunk)
    for k in (1, 7):
        np.testing.assert_array_equal(aligned(lags, f"lag_{k}"), grouped.shift(k).to_numpy())
    rolled = add_rolling_means(frame, ["store"], ["date"], "sales", [5], chunk=chunk)
    want = grouped.transform(lambda s: s.shift(1).rolling(5).mean()).to_numpy()
    np.testing.assert_allclose(aligned(rolled, "roll_5"), want)


@pytest.mark.parametrize("chunk", [32, 4096])
def test_centered_mean_equals_pandas(frame, pdf, chunk):
    got = centered_mean(frame, ["store"], ["date"], "sales", 14, 8, chunk=chunk)
    want = pdf.groupby("store")["sales"].transform(
        lambda s: s.rolling(14, center=True, min_periods=8).mean()
    )
    np.testing.assert_allclose(aligned(got, "centered_mean"), want.to_numpy())


def test_lag_of_lag_is_a_longer_lag(frame):
    once = add_lags(frame, ["store"], ["date"], "sales", [2])
    twice = add_lags(once, ["store"], ["date"], "lag_2", [3]).withColumnRenamed("lag_3", "composed")
    direct = add_lags(frame, ["store"], ["date"], "sales", [5])
    np.testing.assert_array_equal(aligned(twice, "composed"), aligned(direct, "lag_5"))


def test_a_long_series_is_spread_over_chunks(spark):
    df = spark.range(20000).select(
        F.lit("hot").alias("store"),
        F.date_add(F.lit("1960-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.col("id").cast("double").alias("sales"),
    )
    out = add_lags(df, ["store"], ["date"], "sales", [1])
    assert out.where((F.col("sales") > 0) & (F.col("lag_1") != F.col("sales") - 1)).count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    row_windows = [w for w in windows if "row_number()" in w or "lag(" in w]
    assert row_windows and all("_chunk" in w or "_block" in w for w in row_windows)


def test_positions_drop_null_keys(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 2), ("b", 9)], "k string, o int")
    got = with_positions(df, ["k"], ["o"], [F.floor(F.col("o") / 2)])
    assert sorted((r.k, r.o, r._pos) for r in got.collect()) == [("a", 1, 0), ("a", 3, 1), ("b", 9, 0)]


def test_rows_without_a_date_come_last(spark):
    rows = [("a", None, 9.0), ("a", START, 1.0), ("a", START + dt.timedelta(days=400), 2.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = add_lags(df, ["k"], ["d"], "v", [1]).collect()
    assert {r.v: r.lag_1 for r in got} == {1.0: None, 2.0: 1.0, 9.0: 2.0}


def test_top_n_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    best = top_n_per_group(df, ["k"], [F.desc("id")], 2)
    assert sorted(r.id for r in best.collect()) == [994, 995, 996, 997, 998, 999]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_group_stat_feature_is_null_for_a_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0)], "k string, v double")
    got = {(r.k, r.v): r.m for r in group_stat_feature(df, "k", "v", F.median, "m").collect()}
    assert got == {("a", 1.0): 2.0, ("a", 3.0): 2.0, (None, 5.0): None}


def test_time_and_period_index_compress_gaps(spark):
    days = ["2010-01-05", "2010-02-01", "2010-11-01", "2011-04-01"]
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "d string").select(F.to_date("d").alias("d"))
    assert [r.time_idx for r in time_index(df, "d").orderBy(F.asc_nulls_last("d")).collect()] == [0, 1, 2, 3, None]
    got = period_index(df, "d", "quarter").orderBy(F.asc_nulls_last("d")).collect()
    assert [r.period_id for r in got] == [0, 0, 1, 2, None]
    by_calendar = period_index(df, "d", "quarter", calendar=True).orderBy(F.asc_nulls_last("d"))
    assert [r.period_id for r in by_calendar.collect()] == [0, 0, 3, 5, None]


def test_autocorr_flat_and_per_store(spark):
    rng = np.random.default_rng(0)
    rows = [("f", s, START + dt.timedelta(days=i), float(v)) for s in ("a", "b") for i, v in enumerate(rng.normal(size=50))]
    df = spark.createDataFrame(rows, "family string, store string, date date, v double")
    pdf = pd.DataFrame(rows, columns=["family", "store", "date", "v"])
    flat = autocorr(df, ["family"], ["store"], "date", "v", flat=True).first().autocorr
    assert flat == pytest.approx(pdf.v.autocorr(1))
    each = autocorr(df, ["family"], ["store"], "date", "v").first().autocorr
    assert each == pytest.approx(pdf.groupby("store").v.apply(lambda s: s.autocorr(1)).mean())


def numpy_pacf(x, nlags):
    """Yule-Walker solutions of growing order, an independent route to the same numbers."""
    x = x - x.mean()
    gamma = np.array([np.sum(x[k:] * x[: len(x) - k]) / len(x) for k in range(nlags + 1)])
    out = [1.0]
    for k in range(1, nlags + 1):
        toeplitz = gamma[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        out.append(np.linalg.solve(toeplitz, gamma[1 : k + 1])[-1])
    return np.array(out)


def test_pacf_equals_yule_walker(spark):
    rng = np.random.default_rng(1)
    x = np.zeros(300)
    for i in range(1, 300):
        x[i] = 0.6 * x[i - 1] + rng.normal()
    rows = [("s", START + dt.timedelta(days=i), float(v)) for i, v in enumerate(x)]
    got = pacf(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], ["d"], "v", 12)
    np.testing.assert_allclose([r.pacf for r in got.orderBy("lag").collect()], numpy_pacf(x, 12), atol=1e-8)


def test_series_sanity_equals_pandas(spark):
    rows = [("quiet", 0.0)] * 95 + [("quiet", 5.0)] * 5 + [("wild", v) for v in (1.0, 100.0, 1.0, 2.0)] + [("none", 0.0)] * 3
    got = series_sanity(spark.createDataFrame(rows, "family string, sales double"), "family", "sales")
    got = {r.family: r for r in got.collect()}
    assert got["quiet"].flag_sparsity and not got["wild"].flag_sparsity
    assert got["wild"].flag_high_volatility and not got["quiet"].flag_high_volatility
    assert got["none"].cv_active == 0.0 and got["none"].mean_sales_active is None
    wild = pd.Series([1.0, 100.0, 1.0, 2.0])
    assert got["wild"].cv_active == pytest.approx(wild.std() / wild.mean())


def test_fill_panel(spark):
    rows = [("a", dt.date(2020, 1, 1), 2.0), ("b", dt.date(2020, 1, 3), 3.0)]
    out = fill_panel(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", "v")
    assert [(r.k, r.d.day, r.v) for r in out.orderBy("k", "d").collect()] == [
        ("a", 1, 2.0), ("a", 2, 0.0), ("a", 3, 0.0), ("b", 1, 0.0), ("b", 2, 0.0), ("b", 3, 3.0),
    ]


def full_panel(spark, days=60):
    rows = [
        (f, s, START + dt.timedelta(days=i), float((i * p) % 13))
        for p, f in ((3, "x"), (5, "y")) for s in ("1", "2", "3") for i in range(days)
    ]
    return spark.createDataFrame(rows, "family string, store string, date date, sales double")


def test_build_features_equals_pandas(spark):
    df = full_panel(spark)
    spec = fit_spec(df, lags=(1, 7), rolls=(7,))
    got = build_features(df, (1, 7), (7,), spec=spec).toPandas().sort_values(["family", "store", "date"])
    pdf = df.toPandas().sort_values(["family", "store", "date"])
    g = pdf.groupby(["family", "store"])["sales"]
    pdf["lag_1"], pdf["lag_7"] = g.shift(1), g.shift(7)
    pdf["roll_7"] = g.transform(lambda s: s.shift(1).rolling(7).mean())
    pdf["is_active"] = ((pdf.lag_1 > 0) | (pdf.lag_7 > 0)).astype(int)
    pdf = pdf.dropna()
    for c in ("lag_1", "lag_7", "roll_7", "is_active", "sales"):
        np.testing.assert_allclose(got[c].to_numpy(), pdf[c].to_numpy())
    assert (got["store_3_time"] == got.time_idx * (got.store == "3")).all()
    dates = pd.to_datetime(got.date)
    assert (got["dayofweek_2"] == (dates.dt.dayofweek == 2)).all()
    assert set(spec.linear_columns()) <= set(got.columns) and set(spec.tree_columns()) <= set(got.columns)


def test_forecast_features_continue_the_index_and_keep_training_labels(spark):
    df = full_panel(spark, 40)
    spec = fit_spec(df)
    index = date_index(df)
    last = START + dt.timedelta(days=39)
    rows = [("x", "2", last), ("x", "2", last + dt.timedelta(days=5)), ("x", "new", last + dt.timedelta(days=1))]
    future = spark.createDataFrame(rows, "family string, store string, date date")
    got = build_forecast_features(future, spec, index).orderBy("date").collect()
    assert [r.time_idx for r in got] == [39, 40, 44]
    assert got[1].store_1 == got[1].store_2 == got[1].store_3 == 0
    # January rows keep their own month column although only one month is asked for.
    assert spec.months == [1, 12] and got[0].month_1 == 1
    assert FeatureSpec(**spec.to_dict()) == spec
    assert PanelColumns().value == "sales"


def test_only_rows_next_to_a_cut_are_exchanged(spark):
    """A series with most of the rows is many pieces; the panel is shuffled once."""
    df = spark.range(30000).select(
        F.when(F.col("id") < 24000, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("store"),
        F.timestamp_seconds(F.col("id") * 977 % 30011).alias("ts"),
        F.col("id").cast("double").alias("sales"),
    )
    exprs = {"lag_2": lag_of("sales", 2), "roll": trailing_mean("sales", 5), "next": lambda w: F.lead("sales", 3).over(w)}
    got = series_window(df, ["store"], ["ts"], exprs, before=5, after=3, chunk=1000).toPandas()
    want = df.toPandas().sort_values(["store", "ts"]).reset_index(drop=True)
    got = got.sort_values(["store", "ts"]).reset_index(drop=True)
    by = want.groupby("store")["sales"]
    assert len(got) == len(want)
    np.testing.assert_array_equal(got.lag_2, by.shift(2))
    np.testing.assert_array_equal(got.next, by.shift(-3))
    np.testing.assert_allclose(got.roll, by.transform(lambda s: s.shift(1).rolling(5).mean()))
    cuts = long_groups(df, ["store"], "ts", 1000)
    pieces = with_blocks(df, ["store"], "ts", cuts).groupBy("store", "_block").count().toPandas()
    assert set(cuts.toPandas()["_k_store"]) == {"hot"} and pieces["count"].max() < 1500
    short = series_window(df, ["store"], ["ts"], exprs, before=5, after=3, chunk=100_000)
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
