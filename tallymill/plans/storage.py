"""Files written and read back, registered views, sampled pairs, and linear fits in closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators.encode import sample_bucket
from tallymill.operators.linear import fit_linear, fit_ridge
from tallymill.plans.registry import iso, query, rounded
from tallymill.session import scratch_path
from tallymill.sources.files import read_csv, write_csv
from tallymill.sources.tables import register_tables


@query(
    "csv_events",
    """
    SELECT event_type, strftime(min(ts), '%Y-%m-%d') AS first_day, count(*) AS n,
           count(DISTINCT user_id) AS users, round(sum(value), 2) AS total
    FROM events GROUP BY event_type
    """,
)
def csv_events(t):
    """Events as CSV with a declared schema, read back and summed."""
    path = scratch_path(t.spark, "events-csv")
    write_csv(t.events.select("event_id", F.to_date("ts").alias("day"), "user_id", "event_type", "value"), path)
    schema = "event_id bigint, day date, user_id bigint, event_type string, value double"
    out = (
        read_csv(t.spark, path, schema)
        .groupBy("event_type")
        .agg(
            iso(F.min("day")).alias("first_day"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("user_id").alias("users"),
            F.sum("value").alias("total"),
        )
    )
    return rounded(out, total=2)


_VIEW_SQL = """
    SELECT r_name, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, o_orderstatus
"""


@query("registered_views", _VIEW_SQL)
def registered_views(t):
    """Plain SQL over the tables registered as views."""
    register_tables(t.spark, t.folder, ("orders", "customer", "nation", "region"))
    return t.spark.sql(_VIEW_SQL)


@query(
    "sampled_pairs",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem
    WHERE ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|17'), 1, 8))::BIGINT % 100 < 10
    """,
)
def sampled_pairs(t):
    """The points of a pair plot: two numbers and a colour of a tenth of the rows, by hash."""
    drawn = t.lineitem.where(sample_bucket(["l_orderkey", "l_linenumber"], 17) < 10)
    return drawn.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")


@query(
    "linear_by_group",
    """
    SELECT l_returnflag, count(*) AS n,
           round(regr_slope(l_extendedprice, l_quantity), 4) AS ols_slope,
           round(regr_intercept(l_extendedprice, l_quantity), 2) AS ols_intercept,
           round(regr_sxy(l_extendedprice, l_quantity) / (regr_sxx(l_extendedprice, l_quantity) + 1000), 4) AS ridge_slope,
           round(avg(l_extendedprice) - avg(l_quantity) * regr_sxy(l_extendedprice, l_quantity)
                 / (regr_sxx(l_extendedprice, l_quantity) + 1000), 2) AS ridge_intercept
    FROM lineitem GROUP BY l_returnflag
    """,
)
def linear_by_group(t):
    """Least squares and ridge of price on quantity per group."""
    lines = t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice")
    keys, feature, target = ["l_returnflag"], ["l_quantity"], "l_extendedprice"
    plain = fit_linear(lines, keys, feature, target).select(
        *keys, "n", F.col("coef")[0].alias("ols_slope"), F.col("intercept").alias("ols_intercept")
    )
    ridge = fit_ridge(lines, keys, feature, target, 1000.0).select(
        *keys, F.col("coef")[0].alias("ridge_slope"), F.col("intercept").alias("ridge_intercept")
    )
    return rounded(plain.join(ridge, keys), ols_slope=4, ols_intercept=2, ridge_slope=4, ridge_intercept=2)
