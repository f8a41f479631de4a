import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallymill.operators.cohorts import cohort_activity, retention, rfm_segments, rfm_table
from tallymill.session import scratch_root, stored
from tallymill.sources import (
    describe_schema,
    preview,
    read_csv,
    read_sharded,
    register_tables,
    write_csv,
    write_sharded,
)


@pytest.fixture(scope="module")
def retail(spark):
    """Four quarters with one missing; customer 1 holds a third of all rows."""
    rng = np.random.default_rng(0)
    days = [dt.datetime(2010, m, d, 10) for m in (1, 2, 4, 5, 10, 12) for d in (3, 9, 20)]
    rows = []
    for i in range(300):
        customer = 1 if i % 3 == 0 else int(rng.integers(2, 20))
        rows.append((customer, days[int(rng.integers(len(days)))], float(rng.integers(1, 9))))
    rows.append((None, days[0], 5.0))
    return spark.createDataFrame(rows, "customer int, ts timestamp_ntz, amount double")


def test_retention_equals_pandas(retail):
    pdf = retail.toPandas().dropna(subset=["customer"])
    quarter = pdf.ts.dt.to_period("Q")
    ids = {q: i for i, q in enumerate(sorted(quarter.unique()))}
    pdf["pid"] = quarter.map(ids)
    pdf["cohort"] = pdf.groupby("customer").pid.transform("min")
    pdf["age"] = pdf.pid - pdf.cohort
    counts = pdf.groupby(["cohort", "age"]).customer.nunique()
    size = counts.xs(0, level="age")
    got = retention(cohort_activity(retail, "customer", "ts")).collect()
    assert len(got) == len(counts)
    for r in got:
        assert r.n_customers == counts[(r.cohort_id, r.age)]
        assert r.retention == pytest.approx(round(r.n_customers / size[r.cohort_id], 2) * 100)
        assert r.age != 0 or r.retention == 100.0
    sums = cohort_activity(retail, "customer", "ts", sums={"amount": F.col("amount")})
    total = sums.groupBy("cohort_id", "age").agg((F.sum("amount") / F.sum("rows")).alias("m"))
    want = pdf.groupby(["cohort", "age"]).amount.mean()
    assert {(r.cohort_id, r.age): pytest.approx(r.m) for r in total.collect()} == want.to_dict()


def test_rfm_of_ten_customers(spark):
    """Customer k buys k times, at last on 10 o'clock of January k, for 2 each time."""
    rows = [(k, dt.datetime(2010, 1, k - (n > 0) * (k > 1), 10), 2.0) for k in range(1, 11) for n in range(k)]
    rows.append((None, dt.datetime(2011, 1, 1), 9.0))
    df = spark.createDataFrame(rows, "customer int, ts timestamp_ntz, amount double")
    table = rfm_table(df.where("ts < '2010-06-01'"), "customer", "ts", F.col("amount"))
    seen = {r.customer: (r.recency, r.frequency, r.monetary_value) for r in table.collect()}
    assert seen == {
        1: (10, 1, 2.0), 2: (9, 2, 4.0), 3: (8, 3, 6.0), 4: (7, 4, 8.0), 5: (6, 5, 10.0),
        6: (5, 6, 12.0), 7: (4, 7, 14.0), 8: (3, 8, 16.0), 9: (2, 9, 18.0), 10: (1, 10, 20.0),
    }
    scored = rfm_segments(table, "customer").collect()
    # Two customers in each fifth of both measures.
    assert {r.customer: (r.recency_score, r.frequency_score, r.rfm_segment) for r in scored} == {
        1: (1, 1, "Hibernating"), 2: (1, 1, "Hibernating"), 3: (2, 2, "Hibernating"), 4: (2, 2, "Hibernating"),
        5: (3, 3, "Need Attention"), 6: (3, 3, "Need Attention"), 7: (4, 4, "Loyal Customers"),
        8: (4, 4, "Loyal Customers"), 9: (5, 5, "Champions"), 10: (5, 5, "Champions"),
    }


def test_sharded_scan_prunes_folders(spark, tmp_path):
    rows = [(dt.datetime(2017, 7, d, 1), d) for d in (1, 2, 3, 31)]
    path = str(tmp_path / "days")
    write_sharded(spark.createDataFrame(rows, "ts timestamp_ntz, n int"), path, F.col("ts"))
    df = read_sharded(spark, path, "20170702", "20170731")
    assert sorted((r.suffix, r.n) for r in df.collect()) == [("20170702", 2), ("20170703", 3), ("20170731", 31)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(suffix" in plan


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2017, 8, 16), 2.5), (2, None, None)], "id int, d date, v double")
    write_csv(df, str(tmp_path / "csv"))
    typed = read_csv(spark, str(tmp_path / "csv"), "id int, d date, v double")
    assert sorted(typed.collect(), key=lambda r: r.id) == sorted(df.collect(), key=lambda r: r.id)
    assert read_csv(spark, str(tmp_path / "csv")).schema["id"].dataType.simpleString() == "int"


def test_catalog_and_preview(spark, small):
    assert "orders" in register_tables(spark, small)
    assert spark.sql("SELECT count(*) FROM nation").first()[0] == 25
    seen = describe_schema(spark.table("nation")).orderBy("position").collect()
    assert [(r.column_name, r.dtype) for r in seen][:2] == [("n_nationkey", "int"), ("n_name", "string")]
    assert preview(spark.table("orders")).count() == 5


def test_scratch_folder_follows_the_session(spark):
    root = scratch_root(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert root.startswith(base) and root.endswith(spark.sparkContext.applicationId) and root == scratch_root(spark)
    df = stored(spark.range(5), "five")
    assert df.count() == 5 and root.split(":")[-1] in df.inputFiles()[0]
