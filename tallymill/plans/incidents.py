"""Counts of dated records: growth, peaks, monthly tables, answered shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.calendar import between_periods
from tallymill.operators.aggregates import yoy_growth
from tallymill.operators.reshape import pivot_table
from tallymill.operators.windows import top_n_per_group
from tallymill.plans.registry import query, rounded


@query(
    "yoy_growth",
    """
    WITH a AS (SELECT o_orderpriority, count(*) AS n FROM orders
               WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'F' GROUP BY o_orderpriority),
         b AS (SELECT o_orderpriority, count(*) AS n FROM orders
               WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F' GROUP BY o_orderpriority)
    SELECT a.o_orderpriority, a.n AS n_before, b.n AS n_after,
           round((b.n - a.n)::DOUBLE / a.n * 100, 6) AS increase_percent
    FROM a JOIN b ON a.o_orderpriority = b.o_orderpriority
    WHERE b.n - a.n > 0
    ORDER BY increase_percent DESC, o_orderpriority
    """,
)
def growth_between_years(t):
    won = between_periods(t.orders, "o_orderdate", "1996", "1997").where(
        F.col("o_orderstatus") == "F"
    )
    out = yoy_growth(won, ["o_orderpriority"], F.year("o_orderdate"), 1996, 1997, 0)
    return rounded(out, increase_percent=6).orderBy(F.desc("increase_percent"), "o_orderpriority")


@query(
    "peak_month_per_year",
    """
    WITH m AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                      CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
         r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY n DESC, month) AS k FROM m)
    SELECT year, month, n FROM r WHERE k = 1 ORDER BY year DESC
    """,
)
def peak_month_per_year(t):
    counted = (
        t.orders.where(F.col("o_orderstatus") == "F")
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return top_n_per_group(counted, ["year"], [F.desc("n"), F.asc("month")]).orderBy(F.desc("year"))


_MONTHLY_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) AS n
    FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND year(o_orderdate) < 2001
    GROUP BY 1, 2
"""


def _monthly(t):
    return (
        between_periods(t.orders, "o_orderdate", hi="2000")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("monthly_counts", _MONTHLY_SQL + " ORDER BY year, month")
def monthly_counts(t):
    return _monthly(t).orderBy("year", "month")


@query(
    "monthly_pivot",
    f"WITH m AS ({_MONTHLY_SQL}) SELECT year"
    + "".join(f", max(n) FILTER (month = {number}) AS m{number}" for number in range(1, 13))
    + " FROM m GROUP BY year ORDER BY year",
)
def monthly_pivot(t):
    # Years are rows, so any history fits; the columns are the calendar's twelve months.
    months = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    return pivot_table(_monthly(t), ["year"], "month", F.first("n"), months, prefix="m").orderBy("year")


@query(
    "month_average",
    f"WITH m AS ({_MONTHLY_SQL}) SELECT month, round(avg(n), 6) AS average FROM m GROUP BY month ORDER BY month",
)
def month_average(t):
    out = _monthly(t).groupBy("month").agg(F.avg("n").alias("average"))
    return rounded(out, average=6).orderBy("month")


@query(
    "answer_rate_by_year",
    """
    WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS total,
                      count(*) FILTER (o_orderstatus = 'F') AS answered
               FROM orders GROUP BY 1)
    SELECT *, round(answered::DOUBLE / total * 100, 6) AS percent FROM y ORDER BY year
    """,
)
def answer_rate_by_year(t):
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("answered")
    )
    out = yearly.select("*", (F.try_divide("answered", "total") * 100).alias("percent"))
    return rounded(out, percent=6).orderBy("year")


@query(
    "tenure_profile",
    """
    WITH u AS (SELECT c_custkey, c_acctbal, min(o_orderdate) AS first_order,
                      count(DISTINCT o_orderkey) AS n_orders
               FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL),
         p AS (SELECT CAST(floor(date_diff('day', CAST(first_order AS DATE), DATE '2001-08-02') / 365.25)
                           AS BIGINT) AS tenure_years, * FROM u)
    SELECT tenure_years, count(c_custkey) AS num_users, round(avg(c_acctbal), 4) AS avg_balance,
           round(avg(n_orders), 6) AS avg_orders
    FROM p GROUP BY tenure_years ORDER BY tenure_years
    """,
)
def tenure_profile(t, as_of: str = "2001-08-02"):
    # Orders shrink to one row per customer before they meet the customers.
    history = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.count_distinct("o_orderkey").alias("n_orders")
    )
    users = t.customer.join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
    years = F.floor(F.datediff(F.lit(as_of).cast("date"), F.to_date("first_order")) / 365.25)
    out = (
        users.groupBy(years.alias("tenure_years"))
        .agg(
            F.count("c_custkey").alias("num_users"),
            F.avg("c_acctbal").alias("avg_balance"),
            F.avg(F.coalesce("n_orders", F.lit(0))).alias("avg_orders"),
        )
    )
    return rounded(out, avg_balance=4, avg_orders=6).orderBy("tenure_years")


@query(
    "most_granted",
    """
    SELECT p_name, p_type, count(*) AS num_grants, count(DISTINCT p_brand) AS num_brands
    FROM part WHERE p_type = 'PROMO' GROUP BY p_name, p_type
    ORDER BY num_grants DESC, p_name LIMIT 10
    """,
)
def most_granted(t):
    return (
        t.part.where(F.col("p_type") == "PROMO")
        .groupBy("p_name", "p_type")
        .agg(F.count(F.lit(1)).alias("num_grants"), F.count_distinct("p_brand").alias("num_brands"))
        .orderBy(F.desc("num_grants"), "p_name")
        .limit(10)
    )


@query(
    "first_response",
    """
    WITH qa AS (SELECT o_orderkey, dayofweek(o_orderdate) + 1 AS day_of_week,
                       date_sub('minute', o_orderdate, l_shipdate) AS minutes,
                       row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate) AS k
                FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
         f AS (SELECT *, coalesce(minutes BETWEEN 1440 AND 86400, FALSE) AS in_time FROM qa WHERE k = 1)
    SELECT CAST(day_of_week AS INTEGER) AS day_of_week, count(DISTINCT o_orderkey) AS total,
           count(*) FILTER (in_time) AS in_time,
           round((count(*) FILTER (in_time))::DOUBLE / count(DISTINCT o_orderkey) * 100, 6) AS percent
    FROM f GROUP BY 1
    """,
)
def first_response(t, lo_minutes: int = 1440, hi_minutes: int = 86400):
    # The first response of an order is a minimum, so the lines shrink to one row per
    # order before the join; ranking all of an order's lines is not needed.
    first = t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("responded"))
    asked = t.orders.groupBy("o_orderkey").agg(F.min("o_orderdate").alias("asked"))
    minutes = F.timestamp_diff("MINUTE", F.col("asked"), F.col("responded"))
    joined = asked.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.dayofweek("asked").alias("day_of_week"),
        F.coalesce(minutes.between(lo_minutes, hi_minutes), F.lit(False)).alias("hit"),
    )
    out = joined.groupBy("day_of_week").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("hit").alias("in_time")
    )
    return rounded(out.withColumn("percent", F.col("in_time") / F.col("total") * 100), percent=6)
