"""Marketplace orders by time, place, price and kind of payment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.calendar import (
    DAY_NAMES,
    DAY_PARTS,
    between_periods,
    calendar_features,
    month_start,
)
from tallymill.operators.aggregates import complete_categories, multi_agg, value_counts
from tallymill.operators.cleaning import map_values
from tallymill.operators.ranking import order_by_labels
from tallymill.plans.registry import iso, query, rounded


def orders_with_place(t):
    """Orders with the customer's nation."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def orders_per_customer(t, *extra):
    """Order count per customer (and ``extra``): what is joined to places instead of orders.

    A customer with a third of all orders becomes one row before any join.
    """
    return t.orders.groupBy("o_custkey", *extra).agg(F.count(F.lit(1)).alias("n"))


def with_nation(df, t):
    return df.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


@query(
    "status_counts",
    """SELECT o_orderstatus, count(*) AS count FROM orders WHERE o_orderstatus IS NOT NULL
       GROUP BY o_orderstatus ORDER BY count DESC, o_orderstatus""",
)
def status_counts(t):
    return value_counts(t.orders, "o_orderstatus")


@query(
    "orders_over_time",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           count(*) AS num_orders, strftime(min(date_trunc('month', o_orderdate)), '%Y-%m-%d') AS year_month,
           min(monthname(o_orderdate)) AS month_name
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def orders_over_time(t):
    return (
        t.orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("num_orders"))
        .withColumn("_start", F.make_date("year", "month", F.lit(1)))
        .select(
            "year",
            "month",
            "num_orders",
            iso(F.col("_start")).alias("year_month"),
            F.date_format("_start", "MMMM").alias("month_name"),
        )
        .orderBy("year", "month")
    )


@query(
    "orders_by_dayname",
    """
    SELECT dayname(ts) AS dayname, count(*) AS num_orders FROM events GROUP BY 1
    """,
)
def orders_by_dayname(t):
    counted = (
        calendar_features(t.events.select("ts"), "ts")
        .groupBy("dayname")
        .agg(F.count(F.lit(1)).alias("num_orders"))
    )
    return order_by_labels(counted, "dayname", DAY_NAMES)


@query(
    "orders_by_timeofday",
    """
    SELECT p.timeofday, count(e.ts) AS num_orders
    FROM (VALUES ('Night', 0), ('Morning', 6), ('Afternoon', 12), ('Evening', 18)) AS p(timeofday, h)
    LEFT JOIN (SELECT ts FROM events WHERE event_type = 'purchase') e
           ON hour(e.ts) >= p.h AND hour(e.ts) < p.h + 6
    GROUP BY 1
    """,
)
def orders_by_timeofday(t):
    bought = t.events.where(F.col("event_type") == "purchase").select("ts")
    counted = (
        calendar_features(bought, "ts").groupBy("timeofday").agg(F.count(F.lit(1)).alias("num_orders"))
    )
    return complete_categories(counted, "timeofday", DAY_PARTS, "num_orders")


@query(
    "calendar_columns",
    """
    SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek,
           dayname(ts) AS dayname, CAST(quarter(ts) AS INTEGER) AS quarter,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(dayofyear(ts) AS INTEGER) AS dayofyear, CAST(day(ts) AS INTEGER) AS dayofmonth,
           CAST(week(ts) AS INTEGER) AS weekofyear,
           CASE WHEN hour(ts) <= 5 THEN 'Night' WHEN hour(ts) <= 11 THEN 'Morning'
                WHEN hour(ts) <= 17 THEN 'Afternoon' ELSE 'Evening' END AS timeofday,
           count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def calendar_columns(t):
    made = calendar_features(t.events.select("ts"), "ts").drop("ts")
    return made.groupBy(*made.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "orders_by_state",
    """
    SELECT n_name, count(*) AS num_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY num_orders DESC, n_name
    """,
)
def orders_by_state(t):
    return (
        with_nation(orders_per_customer(t), t)
        .groupBy("n_name")
        .agg(F.sum("n").alias("num_orders"))
        .orderBy(F.desc("num_orders"), "n_name")
    )


@query(
    "orders_by_city_top",
    """
    SELECT n_name || '/' || c_mktsegment AS city, count(*) AS num_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1 ORDER BY num_orders DESC, city LIMIT 10
    """,
)
def orders_by_city_top(t):
    return (
        with_nation(orders_per_customer(t), t)
        .groupBy(F.concat_ws("/", "n_name", "c_mktsegment").alias("city"))
        .agg(F.sum("n").alias("num_orders"))
        .orderBy(F.desc("num_orders"), "city")
        .limit(10)
    )


@query(
    "orders_by_region_month",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS year_month, r_name AS region,
           count(*) AS num_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-09-01'
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def orders_by_region_month(t):
    within = between_periods(t.orders, "o_orderdate", "1997-01", "1998-08")
    per_customer = within.groupBy("o_custkey", month_start(F.col("o_orderdate")).alias("_m")).agg(
        F.count(F.lit(1)).alias("n")
    )
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    placed = map_values(with_nation(per_customer, t), "n_name", regions, "region")
    return (
        placed.where(F.col("region").isNotNull())
        .groupBy(iso(F.col("_m")).alias("year_month"), "region")
        .agg(F.sum("n").alias("num_orders"))
        .orderBy("year_month", "region")
    )


def _lines_per_order(t):
    """Sums of an order's lines; lines shrink to one row per order before the join."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("price"),
        F.sum("l_tax").alias("tax"),
        F.count("l_tax").alias("n_tax"),
        F.count("l_extendedprice").alias("n_price"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "price_freight_by_month",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS year_month,
           round(sum(l_extendedprice), 2) AS price, count(*) AS num_orders, round(avg(l_tax), 8) AS avg_value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-09-01'
    GROUP BY 1 ORDER BY 1
    """,
)
def price_freight_by_month(t):
    within = between_periods(t.orders, "o_orderdate", "1997-01", "1998-08")
    out = (
        _lines_per_order(t)
        .join(within, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(iso(month_start(F.col("o_orderdate"))).alias("year_month"))
        .agg(
            F.sum("price").alias("price"),
            F.sum("n").alias("num_orders"),
            F.try_divide(F.sum("tax"), F.sum("n_tax")).alias("avg_value"),
        )
    )
    return rounded(out, price=2, avg_value=8).orderBy("year_month")


@query(
    "state_price",
    """
    SELECT n_name, round(avg(l_extendedprice), 4) AS avg_value, round(sum(l_extendedprice), 2) AS sum_value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY avg_value DESC
    """,
)
def state_price(t):
    # Average and sum come from one grouping; nothing is joined back together. The lines
    # shrink to orders and those to customers, so no busy key reaches a join.
    per_customer = (
        _lines_per_order(t)
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum("price").alias("price"), F.sum("n_price").alias("n"))
    )
    out = (
        with_nation(per_customer, t)
        .groupBy("n_name")
        .agg(
            F.try_divide(F.sum("price"), F.sum("n")).alias("avg_value"),
            F.sum("price").alias("sum_value"),
        )
    )
    return rounded(out, avg_value=4, sum_value=2).orderBy(F.desc("avg_value"))


@query(
    "payment_mix",
    """
    SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_value, count(*) AS count
    FROM orders GROUP BY o_orderpriority ORDER BY avg_value DESC
    """,
)
def payment_mix(t):
    # Mean and count of a kind share one grouping, so the counts already are in mean order.
    kinds = (
        t.orders.where(F.col("o_orderpriority").isNotNull())
        .groupBy("o_orderpriority")
        .agg(F.avg("o_totalprice").alias("avg_value"), F.count(F.lit(1)).alias("count"))
    )
    return rounded(kinds, avg_value=4).orderBy(F.desc("avg_value"))


@query(
    "payment_by_month",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS year_month, o_orderpriority,
           count(*) AS sum_value
    FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-09-01'
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def payment_by_month(t):
    return (
        between_periods(t.orders, "o_orderdate", "1997-01", "1998-08")
        .where(F.col("o_orderpriority").isNotNull())
        .groupBy(iso(month_start(F.col("o_orderdate"))).alias("year_month"), "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("sum_value"))
        .orderBy("year_month", "o_orderpriority")
    )


@query(
    "price_by_priority",
    """
    SELECT o_orderpriority, round(avg(o_totalprice), 4) AS o_totalprice_mean,
           count(o_totalprice) AS o_totalprice_count, round(sum(o_totalprice), 2) AS o_totalprice_sum,
           min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
    FROM orders GROUP BY o_orderpriority
    """,
)
def price_by_priority(t):
    out = multi_agg(
        t.orders, ["o_orderpriority"], ["o_totalprice"], ["mean", "count", "sum", "min", "max"]
    )
    return rounded(out, o_totalprice_mean=4, o_totalprice_sum=2)
