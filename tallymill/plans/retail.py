"""Retail lines: extremes, totals, cohorts, recency and frequency segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.calendar import between_periods, quarter_label
from tallymill.functions.scalars import totals
from tallymill.operators.aggregates import multi_agg, share
from tallymill.operators.cohorts import cohort_activity, retention, rfm_segments, rfm_table
from tallymill.operators.ranking import head_tail
from tallymill.operators.reshape import pivot_table
from tallymill.operators.windows import period_index
from tallymill.plans.commerce import orders_per_customer, with_nation
from tallymill.plans.registry import iso, query, rounded
from tallymill.session import stored


@query(
    "extreme_price_rows",
    """
    SELECT 'most' AS kind, l_partkey, l_extendedprice, l_quantity FROM lineitem
    WHERE l_extendedprice = (SELECT max(l_extendedprice) FROM lineitem)
    UNION ALL
    SELECT 'least', l_partkey, l_extendedprice, sum(l_quantity) FROM lineitem
    WHERE l_extendedprice = (SELECT min(l_extendedprice) FROM lineitem) GROUP BY 2, 3
    UNION ALL
    SELECT 'least_discounted', l_partkey, l_extendedprice, sum(l_quantity) FROM lineitem
    WHERE l_discount > 0 AND l_extendedprice = (SELECT min(l_extendedprice) FROM lineitem WHERE l_discount > 0)
    GROUP BY 2, 3
    """,
)
def extreme_price_rows(t):
    lines = t.lineitem.select("l_partkey", "l_extendedprice", "l_quantity", "l_discount")
    price, reduced = F.col("l_extendedprice"), F.coalesce(F.col("l_discount") > 0, F.lit(False))
    # The three extremes come from one scan, the rows that have one from another.
    ends = totals(lines, high=F.max(price), low=F.min(price), low_reduced=F.min(F.when(reduced, price)))
    rows = lines.where(
        (price == ends["high"]) | (price == ends["low"]) | (reduced & (price == ends["low_reduced"]))
    ).select(
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(price == ends["high"], F.lit("most")),
                    F.when(price == ends["low"], F.lit("least")),
                    F.when(reduced & (price == ends["low_reduced"]), F.lit("least_discounted")),
                )
            )
        ).alias("kind"),
    )
    # Every row of the highest price is shown, equal ones counted and spread again; the
    # others are summed per part.
    most = F.col("kind") == "most"
    grouped = rows.groupBy(
        "kind", "l_partkey", "l_extendedprice", F.when(most, F.col("l_quantity")).alias("_own")
    ).agg(F.sum("l_quantity").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    shown = F.sequence(F.lit(1).cast("long"), F.when(most, F.col("_n")).otherwise(1))
    return grouped.select(
        "kind",
        "l_partkey",
        "l_extendedprice",
        F.when(most, F.col("_own")).otherwise(F.col("_sum")).alias("l_quantity"),
        F.explode(shown).alias("_copy"),
    ).drop("_copy")


@query(
    "extreme_customers",
    """
    WITH c AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1),
         r AS (SELECT *, row_number() OVER (ORDER BY total, o_custkey) AS a,
                      row_number() OVER (ORDER BY total DESC, o_custkey DESC) AS b FROM c)
    SELECT o_custkey, round(total, 2) AS total, 'head' AS "end" FROM r WHERE a <= 5
    UNION ALL SELECT o_custkey, round(total, 2), 'tail' FROM r WHERE b <= 5
    """,
)
def extreme_customers(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    return rounded(head_tail(totals, ["total", "o_custkey"], 5), total=2)


@query(
    "country_totals",
    """
    WITH c AS (SELECT n_name, sum(o_totalprice) AS total
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
         r AS (SELECT *, row_number() OVER (ORDER BY total, n_name) AS a,
                      row_number() OVER (ORDER BY total DESC, n_name DESC) AS b FROM c)
    SELECT n_name, round(total, 2) AS total, 'head' AS "end" FROM r WHERE a <= 10
    UNION ALL SELECT n_name, round(total, 2), 'tail' FROM r WHERE b <= 10
    """,
)
def country_totals(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    totals = with_nation(per_customer, t).groupBy("n_name").agg(F.sum("total").alias("total"))
    return rounded(head_tail(totals, ["total", "n_name"], 10), total=2)


@query(
    "country_customers",
    """
    WITH c AS (SELECT n_name, count(DISTINCT o_custkey) AS num_customers
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
         r AS (SELECT *, row_number() OVER (ORDER BY num_customers, n_name) AS a,
                      row_number() OVER (ORDER BY num_customers DESC, n_name DESC) AS b FROM c)
    SELECT n_name, num_customers, 'head' AS "end" FROM r WHERE a <= 10
    UNION ALL SELECT n_name, num_customers, 'tail' FROM r WHERE b <= 10
    """,
)
def country_customers(t):
    # One row per customer already, so the distinct count works on that.
    counts = (
        with_nation(orders_per_customer(t), t)
        .groupBy("n_name")
        .agg(F.count_distinct("o_custkey").alias("num_customers"))
    )
    return head_tail(counts, ["num_customers", "n_name"], 10)


@query(
    "best_worst_product",
    """
    WITH p AS (SELECT p_name, sum(l_quantity) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey
               WHERE p_name NOT IN ('small ring', 'red widget') GROUP BY p_name)
    SELECT arg_max(p_name, (quantity, p_name)) AS most_sold, max(quantity) AS most_quantity,
           arg_min(p_name, (quantity, p_name)) AS least_sold, min(quantity) AS least_quantity FROM p
    """,
)
def best_worst_product(t):
    excluded = F.col("p_name").isNull() | ~F.col("p_name").isin("small ring", "red widget")
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    sold = (
        per_part.join(t.part.where(excluded), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_name")
        .agg(F.sum("quantity").alias("quantity"))
    )
    order = F.struct("quantity", "p_name")
    return sold.agg(
        F.max_by("p_name", order).alias("most_sold"),
        F.max("quantity").alias("most_quantity"),
        F.min_by("p_name", order).alias("least_sold"),
        F.min("quantity").alias("least_quantity"),
    )


_COHORT_SQL = """
    WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS p
               FROM orders WHERE o_orderdate >= DATE '1996-01-01'),
         ids AS (SELECT p, CAST(row_number() OVER (ORDER BY p) - 1 AS INTEGER) AS period_id
                 FROM (SELECT DISTINCT p FROM o)),
         a AS (SELECT o.*, period_id, min(period_id) OVER (PARTITION BY o_custkey) AS cohort_id,
                      min(p) OVER (PARTITION BY o_custkey) AS cohort_start
               FROM o JOIN ids USING (p))
"""


def _later_orders(t):
    return between_periods(t.orders, "o_orderdate", "1996")


@query(
    "cohort_retention",
    _COHORT_SQL
    + """
    , c AS (SELECT cohort_id, cohort_start, period_id - cohort_id AS age, count(DISTINCT o_custkey) AS n
            FROM a GROUP BY ALL)
    SELECT cohort_id, 'Q' || quarter(cohort_start) || '/' || year(cohort_start) AS cohort, age,
           round_even(n::DOUBLE / max(n) FILTER (age = 0) OVER (PARTITION BY cohort_id), 2) * 100 AS retention
    FROM c
    """,
)
def cohort_retention(t):
    # One row per cohort and age that occurs, however long the history is.
    long = retention(cohort_activity(_later_orders(t), "o_custkey", "o_orderdate"))
    return long.select("cohort_id", quarter_label(F.col("cohort_start")).alias("cohort"), "age", "retention")


@query(
    "cohort_quantity",
    _COHORT_SQL
    + """
    SELECT cohort_id, 'Q' || quarter(cohort_start) || '/' || year(cohort_start) AS cohort,
           period_id - cohort_id AS age, round(avg(l_quantity), 6) AS average_quantity
    FROM lineitem JOIN a ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def cohort_quantity(t):
    # Cohorts come from the orders; lines shrink to one row per order before the join.
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.count("l_quantity").alias("lines")
    )
    orders = _later_orders(t).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    activity = cohort_activity(
        orders,
        "o_custkey",
        "o_orderdate",
        sums={"quantity": F.col("quantity"), "lines": F.col("lines")},
    )
    out = (
        activity.groupBy("cohort_id", quarter_label(F.col("cohort_start")).alias("cohort"), "age")
        .agg(F.try_divide(F.sum("quantity"), F.sum("lines")).alias("average_quantity"))
        .where(F.col("average_quantity").isNotNull())
    )
    return rounded(out, average_quantity=6)


@query(
    "sales_by_quarter",
    """
    WITH q AS (SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS p, sum(o_totalprice) AS total
               FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY p) - 1 AS INTEGER) AS quarter_id,
           'Q' || quarter(p) || '/' || year(p) AS quarter, round(total, 2) AS total FROM q
    """,
)
def sales_by_quarter(t):
    # Totals first: the period numbering then only sees one row per quarter.
    totals = (
        _later_orders(t)
        .groupBy(F.trunc("o_orderdate", "quarter").alias("start"))
        .agg(F.sum("o_totalprice").alias("total"))
    )
    out = period_index(totals, "start", "quarter", "quarter_id").select(
        "quarter_id", quarter_label(F.col("start")).alias("quarter"), "total"
    )
    return rounded(out, total=2).orderBy("quarter_id")


@query(
    "sales_by_month",
    """
    SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1 ORDER BY 1
    """,
)
def sales_by_month(t):
    out = (
        _later_orders(t)
        .groupBy(iso(F.trunc("o_orderdate", "month")).alias("month"))
        .agg(F.sum("o_totalprice").alias("total"))
    )
    return rounded(out, total=2).orderBy("month")


_RFM_SQL = """
    WITH r AS (SELECT o_custkey, date_sub('day', max(o_orderdate),
                        (SELECT max(o_orderdate) + INTERVAL 1 DAY FROM orders)) AS recency,
                      count(*) AS frequency, sum(o_totalprice) AS monetary_value FROM orders GROUP BY 1),
         e AS (SELECT quantile_cont(recency, 0.2) AS a, quantile_cont(recency, 0.4) AS b,
                      quantile_cont(recency, 0.6) AS c, quantile_cont(recency, 0.8) AS d, count(*) AS n FROM r),
         k AS (SELECT r.*, e.*, row_number() OVER (ORDER BY frequency, o_custkey) AS f FROM r, e),
         s AS (SELECT o_custkey, recency, frequency, monetary_value,
                      CASE WHEN recency <= a THEN 5 WHEN recency <= b THEN 4 WHEN recency <= c THEN 3
                           WHEN recency <= d THEN 2 ELSE 1 END AS recency_score,
                      CASE WHEN (f - 1) * 5 <= (n - 1) THEN 1 WHEN (f - 1) * 5 <= (n - 1) * 2 THEN 2
                           WHEN (f - 1) * 5 <= (n - 1) * 3 THEN 3 WHEN (f - 1) * 5 <= (n - 1) * 4 THEN 4
                           ELSE 5 END AS frequency_score
               FROM k),
         g AS (SELECT *, CASE
                 WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'Hibernating'
                 WHEN recency_score <= 2 AND frequency_score <= 4 THEN 'At-Risk'
                 WHEN recency_score <= 2 THEN 'Can''t Lose'
                 WHEN recency_score = 3 AND frequency_score <= 2 THEN 'About to Slip'
                 WHEN recency_score = 3 AND frequency_score = 3 THEN 'Need Attention'
                 WHEN recency_score <= 4 AND frequency_score >= 4 THEN 'Loyal Customers'
                 WHEN recency_score = 4 AND frequency_score = 1 THEN 'Promising'
                 WHEN recency_score = 5 AND frequency_score = 1 THEN 'New Customers'
                 WHEN recency_score >= 4 AND frequency_score <= 3 THEN 'Potential Loyalists'
                 ELSE 'Champions' END AS rfm_segment FROM s)
"""


def _segments(t):
    # Scoring reads the customer table several times, so orders are reduced to it once.
    rfm = rfm_table(t.orders, "o_custkey", "o_orderdate", F.col("o_totalprice"))
    return rfm_segments(stored(rfm, "rfm"), "o_custkey")


@query(
    "rfm_segments",
    _RFM_SQL
    + """
    SELECT o_custkey, CAST(recency AS INTEGER) AS recency, frequency, round(monetary_value, 2) AS monetary_value,
           recency_score, frequency_score, rfm_segment FROM g
    """,
)
def customer_segments(t):
    return rounded(_segments(t), monetary_value=2)


@query(
    "rfm_summary",
    _RFM_SQL
    + """
    SELECT rfm_segment, """
    + ", ".join(
        f"round(avg({c}), 4) AS {c}_mean, count({c}) AS {c}_count, {s} AS {c}_sum"
        for c, s in (
            ("recency", "CAST(sum(recency) AS BIGINT)"),
            ("frequency", "CAST(sum(frequency) AS BIGINT)"),
            ("monetary_value", "round(sum(monetary_value), 2)"),
        )
    )
    + " FROM g GROUP BY rfm_segment",
)
def rfm_summary(t):
    out = multi_agg(
        _segments(t),
        ["rfm_segment"],
        ["recency", "frequency", "monetary_value"],
        ["mean", "count", "sum"],
    )
    return rounded(
        out, recency_mean=4, frequency_mean=4, monetary_value_mean=4, monetary_value_sum=2
    )


@query(
    "rfm_mix",
    _RFM_SQL
    + """
    SELECT rfm_segment, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM g), 6) AS share
    FROM g GROUP BY rfm_segment
    """,
)
def rfm_mix(t):
    # Counted twice, once for the total, so the labels are stored.
    labels = stored(_segments(t).select("rfm_segment"), "segments")
    return rounded(share(labels, ["rfm_segment"]), share=6)
