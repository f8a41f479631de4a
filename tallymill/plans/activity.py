"""Distinct counts over repositories of records, and web-session style event queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.columns import pearson
from tallymill.operators.aggregates import nested_average, ordered_path
from tallymill.operators.reshape import explode_list
from tallymill.operators.windows import top_n_per_group
from tallymill.plans.registry import iso, query, rounded
from tallymill.sources.sharded import daily_tables, read_sharded


@query(
    "items_per_token",
    """
    SELECT token, count(DISTINCT p_partkey) AS num_parts
    FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part)
    GROUP BY token ORDER BY num_parts DESC, token
    """,
)
def items_per_token(t):
    tokens = t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("token"))
    return (
        tokens.groupBy("token")
        .agg(F.count_distinct("p_partkey").alias("num_parts"))
        .orderBy(F.desc("num_parts"), "token")
    )


@query(
    "primary_element",
    """
    WITH e AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part),
         r AS (SELECT p_partkey, name, length(name) AS bytes,
                      row_number() OVER (PARTITION BY p_partkey ORDER BY length(name) DESC, name) AS k
               FROM e)
    SELECT p_partkey, name AS primary_name, CAST(bytes AS INTEGER) AS bytes_used
    FROM r WHERE k = 1
    """,
)
def primary_element(t):
    nested = t.part.select(
        "p_partkey",
        F.transform(
            F.split("p_name", " "),
            lambda w: F.struct(w.alias("name"), F.length(w).alias("bytes")),
        ).alias("items"),
    )
    flat = nested.select("p_partkey", F.explode("items").alias("item"))
    best = top_n_per_group(flat, ["p_partkey"], [F.desc("item.bytes"), F.asc("item.name")])
    return best.select(
        "p_partkey", F.col("item.name").alias("primary_name"), F.col("item.bytes").alias("bytes_used")
    )


@query(
    "distinct_by_key",
    """
    SELECT p_type, count(DISTINCT p_name) AS num_names FROM part
    GROUP BY p_type ORDER BY num_names DESC, p_type
    """,
)
def distinct_by_key(t):
    return (
        t.part.groupBy("p_type")
        .agg(F.count_distinct("p_name").alias("num_names"))
        .orderBy(F.desc("num_names"), "p_type")
    )


_ACTIVE_SQL = """
    SELECT n_name, count(DISTINCT o_orderkey) AS num_orders, count(DISTINCT o_custkey) AS num_customers
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
"""


def _active(t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(
            F.count_distinct("o_orderkey").alias("num_orders"),
            F.count_distinct("o_custkey").alias("num_customers"),
        )
    )


@query("top_active", _ACTIVE_SQL + " ORDER BY num_orders DESC, n_name LIMIT 10")
def top_active(t):
    return _active(t).orderBy(F.desc("num_orders"), "n_name").limit(10)


@query(
    "corr_of_counts",
    f"SELECT round(corr(num_customers, num_orders), 6) AS correlation FROM ({_ACTIVE_SQL})",
)
def corr_of_counts(t):
    out = _active(t).agg(
        pearson(F.col("num_customers"), F.col("num_orders")).alias("correlation")
    )
    return rounded(out, correlation=6)


@query(
    "yearly_distinct",
    """
    SELECT c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_orderkey) AS num_orders
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def yearly_distinct(t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", F.year("o_orderdate").alias("year"))
        .agg(F.count_distinct("o_orderkey").alias("num_orders"))
        .orderBy("c_mktsegment", "year")
    )


@query(
    "size_profile",
    """
    SELECT p_brand, round(sum(l_quantity), 2) AS total_size, count(l_partkey) AS num_files,
           round(avg(l_quantity), 6) AS avg_size, max(l_quantity) AS max_size, min(l_quantity) AS min_size
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand ORDER BY sum(l_quantity) DESC, p_brand LIMIT 10
    """,
)
def size_profile(t):
    # Sums, counts and extremes add up, so lines shrink to one row per part first.
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("s"),
        F.count("l_quantity").alias("n"),
        F.count(F.lit(1)).alias("rows"),
        F.max("l_quantity").alias("hi"),
        F.min("l_quantity").alias("lo"),
    )
    out = (
        per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(
            F.sum("s").alias("total_size"),
            F.sum("rows").alias("num_files"),
            F.try_divide(F.sum("s"), F.sum("n")).alias("avg_size"),
            F.max("hi").alias("max_size"),
            F.min("lo").alias("min_size"),
        )
        .orderBy(F.desc("total_size"), "p_brand")
        .limit(10)
    )
    return rounded(out, total_size=2, avg_size=6)


@query(
    "sum_in_suffix_range",
    """
    SELECT event_type, round(sum(value), 2) AS total FROM events
    WHERE strftime(ts, '%Y%m%d') BETWEEN '20240105' AND '20240120'
    GROUP BY event_type ORDER BY total DESC
    """,
)
def sum_in_suffix_range(t):
    # The events as a family of daily tables; only the folders of the range are read.
    path = daily_tables(t.spark, f"{t.folder}/events.parquet", F.col("ts"))
    days = read_sharded(t.spark, path, "20240105", "20240120")
    out = days.groupBy("event_type").agg(F.sum("value").alias("total"))
    return rounded(out, total=2).orderBy(F.desc("total"))


@query(
    "bounce_rate",
    """
    WITH v AS (SELECT user_id, count(user_id) AS total_visits,
                      sum(CASE WHEN event_type = 'error' THEN 1 END)::DOUBLE AS total_bounces
               FROM events GROUP BY user_id)
    SELECT user_id, total_visits, total_bounces,
           round(CASE WHEN total_visits > 0 THEN total_bounces / total_visits END * 100, 6) AS bounce_rate
    FROM v ORDER BY total_visits DESC, user_id
    """,
)
def bounce_rate(t):
    visits = (
        t.events.groupBy("user_id")
        .agg(
            F.count("user_id").alias("total_visits"),
            F.sum(F.when(F.col("event_type") == "error", 1)).cast("double").alias("total_bounces"),
        )
        .withColumn("bounce_rate", F.try_divide("total_bounces", "total_visits") * 100)
    )
    return rounded(visits, bounce_rate=6).orderBy(F.desc("total_visits"), "user_id")


@query(
    "views_per_buyer",
    """
    WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS views,
                      sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS buys
               FROM events GROUP BY 1, 2),
         u AS (SELECT user_id, sum(views) AS views, sum(buys) AS buys FROM s GROUP BY user_id)
    SELECT round(sum(views)::DOUBLE / count(*), 6) AS average_views FROM u WHERE buys >= 1
    """,
)
def views_per_buyer(t):
    events = t.events.withColumn("day", F.to_date("ts"))
    out = nested_average(
        events,
        [
            (
                ["user_id", "day"],
                {
                    "views": F.count_if(F.col("event_type") == "view"),
                    "buys": F.sum(F.when(F.col("event_type") == "purchase", 1)),
                },
            ),
            (["user_id"], {"views": F.sum("views"), "buys": F.sum("buys")}),
        ],
        F.col("buys") >= 1,
        {"average_views": F.try_divide(F.sum("views"), F.count(F.lit(1)))},
    )
    return rounded(out, average_views=6)


@query(
    "purchases_per_buyer",
    """
    WITH u AS (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS visits,
                      sum(CASE WHEN event_type = 'purchase' THEN 1 END) AS buys
               FROM events GROUP BY user_id)
    SELECT round(avg(buys), 6) AS average_purchases FROM u WHERE buys >= 1
    """,
)
def purchases_per_buyer(t):
    # The number of visits is never returned, so it is not counted.
    out = nested_average(
        t.events,
        [(["user_id"], {"buys": F.sum(F.when(F.col("event_type") == "purchase", 1))})],
        F.col("buys") >= 1,
        {"average_purchases": F.avg("buys")},
    )
    return rounded(out, average_purchases=6)


@query(
    "spend_per_session",
    """
    WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day,
                      sum(CASE WHEN event_type = 'purchase' THEN value END) AS revenue
               FROM events GROUP BY 1, 2)
    SELECT round(sum(revenue), 2) AS total_revenue, count(*) AS num_sessions,
           round(sum(revenue) / count(*), 6) AS average_spend FROM s
    """,
)
def spend_per_session(t):
    sessions = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("revenue")
    )
    out = sessions.agg(
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("num_sessions"),
        F.try_divide(F.sum("revenue"), F.count(F.lit(1))).alias("average_spend"),
    )
    return rounded(out, total_revenue=2, average_spend=6)


@query(
    "session_path",
    """
    SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
           coalesce(string_agg(event_type, '->' ORDER BY ts, event_id), '') AS path
    FROM events WHERE event_type <> 'error' GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def session_path(t):
    shown = t.events.where(F.col("event_type") != "error").withColumn("day", iso(F.to_date("ts")))
    return ordered_path(shown, ["user_id", "day"], "event_type", ["ts", "event_id"]).orderBy("user_id", "day")


@query(
    "by_split_value",
    """
    SELECT word, count(*) AS num_contents
    FROM (SELECT trim(unnest(string_split(p_name, ' '))) AS word FROM part)
    GROUP BY word ORDER BY num_contents DESC, word LIMIT 15
    """,
)
def by_split_value(t):
    return (
        explode_list(t.part.select("p_name"), "p_name", "word", " ")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("num_contents"))
        .orderBy(F.desc("num_contents"), "word")
        .limit(15)
    )
