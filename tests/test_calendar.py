import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.functions.calendar import (
    between_periods,
    calendar_features,
    cut,
    future_dates,
    quarter_label,
    seasonal_terms,
)

STAMPS = [
    dt.datetime(2020, 1, 1, 0, 0), dt.datetime(2020, 2, 29, 5, 59), dt.datetime(2021, 1, 3, 6, 0),
    dt.datetime(2024, 12, 30, 12, 1), dt.datetime(2023, 7, 9, 23, 59),
]


def test_calendar_features_match_pandas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(STAMPS)], "i int, ts timestamp_ntz")
    got = calendar_features(df, "ts").orderBy("i").toPandas()
    ts = pd.Series(STAMPS)
    assert list(got.hour) == list(ts.dt.hour)
    assert list(got.dayofweek) == list(ts.dt.dayofweek)
    assert list(got.dayname) == list(ts.dt.day_name())
    assert list(got.quarter) == list(ts.dt.quarter)
    assert list(got.dayofyear) == list(ts.dt.dayofyear)
    assert list(got.weekofyear) == list(ts.dt.isocalendar().week)
    parts = pd.cut(ts.dt.hour, [-1, 5, 11, 17, 23], labels=["Night", "Morning", "Afternoon", "Evening"])
    assert list(got.timeofday) == list(parts.astype(str))


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (11,), (12,), (None,)], "v int")
    got = [r["c"] for r in df.select(cut(F.col("v"), [0, 5, 11], ["lo", "hi"]).alias("c")).collect()]
    assert got == [None, "lo", "lo", "hi", "hi", None, None]


@pytest.mark.parametrize(
    "lo,hi,want",
    [
        ("2020", "2020", 2), ("2020-02", "2021-01", 2), ("2021-01-03", "2021-01-03", 1),
        (None, "2020", 2), ("2023", None, 2), ("2024-12", "2024-12", 1),
    ],
)
def test_between_periods_is_half_open(spark, lo, hi, want):
    df = spark.createDataFrame([(t,) for t in STAMPS], "ts timestamp_ntz")
    assert between_periods(df, "ts", lo, hi).count() == want
    dates = df.select(F.to_date("ts").alias("ts"))
    assert between_periods(dates, "ts", lo, hi).count() == want


def test_between_periods_reaches_the_scan(spark, small):
    df = between_periods(spark.read.parquet(f"{small}/orders.parquet"), "o_orderdate", "1997", "1997-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_quarter_label(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 5, 1),)], "ts timestamp_ntz")
    assert df.select(quarter_label(F.col("ts"))).first()[0] == "Q2/2010"


def test_seasonal_terms(spark):
    day = dt.date(2017, 2, 15)
    df = spark.createDataFrame([(day, dt.date(2017, 1, 1))], "d date, o date")
    row = df.select(*[c.alias(n) for n, c in seasonal_terms(F.col("d"), F.col("o")).items()]).first()
    assert row["const"] == 1.0 and row["trend"] == 46.0 and row["new_year"] == 0.0
    assert [row[f"weekday_{i}"] for i in range(1, 7)] == [float(day.weekday() == i) for i in range(1, 7)]
    assert row["sin_1"] == pytest.approx(math.sin(2 * math.pi * 14 / 28), abs=1e-12)
    assert row["cos_3"] == pytest.approx(math.cos(6 * math.pi * 14 / 28))


def test_future_dates(spark):
    df = spark.createDataFrame([(dt.date(2017, 8, 15),), (dt.date(2017, 8, 14),)], "date date")
    got = [r[0] for r in future_dates(df, "date", 3).orderBy("date").collect()]
    assert got == [dt.date(2017, 8, 16), dt.date(2017, 8, 17), dt.date(2017, 8, 18)]
