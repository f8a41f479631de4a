"""Table profiles, correlations, pivots, percentages, histograms and box numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators.aggregates import share
from tallymill.operators.profile import describe_column, null_counts, profile_all
from tallymill.operators.quantiles import exact_quantiles
from tallymill.operators.reshape import pivot_table
from tallymill.operators.stats import box_stats, correlation_matrix, histograms, kde
from tallymill.plans.registry import query, rounded
from tallymill.sources.tables import TABLES

_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

# The columns of the test tables and their types.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile_sql() -> str:
    parts = []
    for table, schema in _SCHEMAS.items():
        for i, column in enumerate(schema.split(", ")):
            name, kind = column.split(" ")
            distinct = f"count(DISTINCT {name})" if kind == "string" else "CAST(0 AS BIGINT)"
            parts.append(
                f"SELECT '{table}' AS dataset_name, {i} AS position, '{name}' AS feature_name, "
                f"count(*) - count({name}) AS amount_null, "
                f"round((count(*) - count({name}))::DOUBLE / count(*) * 100, 6) AS percent_null, "
                f"'{kind}' AS dtype, {distinct} AS total_cat_entries FROM {table}"
            )
    return " UNION ALL ".join(parts)


@query("table_profile", _profile_sql())
def table_profile(t):
    return rounded(profile_all({name: getattr(t, name) for name in TABLES}), percent_null=6)


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem"
        for a in _NUMERIC
        for b in _NUMERIC
    ),
)
def corr_matrix(t):
    return rounded(correlation_matrix(t.lineitem, _NUMERIC), corr=6)


@query(
    "pivot_counts",
    """
    SELECT l_returnflag, l_linestatus, count(*) FILTER (quarter(l_shipdate) = 1) AS q1,
           count(*) FILTER (quarter(l_shipdate) = 2) AS q2, count(*) FILTER (quarter(l_shipdate) = 3) AS q3,
           count(*) FILTER (quarter(l_shipdate) = 4) AS q4
    FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def pivot_counts(t):
    # The columns are the quarters of any year, so no row is left out.
    lines = t.lineitem.select("l_returnflag", "l_linestatus", F.quarter("l_shipdate").alias("quarter"))
    return pivot_table(
        lines, ["l_returnflag", "l_linestatus"], "quarter", F.count(F.lit(1)), range(1, 5), fill=0, prefix="q"
    ).orderBy("l_returnflag", "l_linestatus")


@query(
    "percent_by_group",
    """
    SELECT c_mktsegment, c_acctbal >= 0 AS in_credit, count(*) AS n,
           round(count(*)::DOUBLE / (SELECT count(*) FROM customer) * 100, 6) AS percent
    FROM customer GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def percent_by_group(t):
    marked = t.customer.select("c_mktsegment", (F.col("c_acctbal") >= 0).alias("in_credit"))
    out = share(marked, ["c_mktsegment", "in_credit"], "percent", 100.0)
    return rounded(out, percent=6).orderBy("c_mktsegment", "in_credit")


@query(
    "numeric_histograms",
    " UNION ALL ".join(
        f"""
    (WITH e AS (SELECT min({c}) AS lo, (max({c}) - min({c})) / 30 AS w FROM lineitem),
         n AS (SELECT CAST(least(29, floor(({c} - lo) / w)) AS INTEGER) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1)
    SELECT '{c}' AS column_name, CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * w, 6) AS bin_start,
           round(lo + (r.bin + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n
    FROM range(30) AS r(bin) CROSS JOIN e LEFT JOIN n ON n.bin = r.bin)"""
        for c in _NUMERIC
    ),
)
def numeric_histograms(t):
    return rounded(histograms(t.lineitem, _NUMERIC, 30), bin_start=6, bin_end=6)


@query(
    "box_by_group",
    """
    WITH q AS (SELECT c_mktsegment, quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.5) AS median,
                      quantile_cont(c_acctbal, 0.75) AS q3 FROM customer GROUP BY 1)
    SELECT c_mktsegment, count(*) AS n, round(min(q1), 4) AS q1, round(min(median), 4) AS median,
           round(min(q3), 4) AS q3,
           min(c_acctbal) FILTER (c_acctbal BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max(c_acctbal) FILTER (c_acctbal BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER (c_acctbal NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM customer JOIN q USING (c_mktsegment) GROUP BY 1
    """,
)
def box_by_group(t):
    out = box_stats(t.customer, ["c_mktsegment"], "c_acctbal")
    return rounded(out, q1=4, median=4, q3=4)


@query(
    "value_kde",
    """
    WITH s AS (SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h,
                      min(value) AS lo, max(value) AS hi FROM events),
         g AS (SELECT CAST(i AS INTEGER) AS i, lo - 3 * h + i * (hi - lo + 6 * h) / 63 AS x, n, h
               FROM s, range(64) AS r(i))
    SELECT i, round(x, 6) AS x, round(sum(exp(-0.5 * ((x - value) / h) ** 2)) / (n * h * sqrt(2 * pi())), 8) AS density
    FROM g, events GROUP BY i, x, n, h
    """,
)
def value_kde(t):
    return rounded(kde(t.events, "value", 64), x=6, density=8)


@query(
    "describe_column",
    """
    SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
           round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
           round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
           round(quantile_cont(l_extendedprice, 0.75), 4) AS q75, max(l_extendedprice) AS max
    FROM lineitem
    """,
)
def described_price(t):
    return rounded(describe_column(t.lineitem, "l_extendedprice"), mean=4, std=4, q25=4, q50=4, q75=4)


@query(
    "group_quantiles",
    """
    SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 4) AS p10,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
           round(quantile_cont(l_extendedprice, 0.99), 4) AS p99
    FROM lineitem GROUP BY 1, 2
    """,
)
def group_quantiles(t):
    out = exact_quantiles(
        t.lineitem, "l_extendedprice", [0.1, 0.5, 0.99], ["l_returnflag", "l_linestatus"],
        ["p10", "p50", "p99"],
    )
    return rounded(out, p10=4, p50=4, p99=4)


@query(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature_name, count(*) - count({e}) AS amount_null FROM lineitem"
        for c, e in (
            ("l_quantity", "CASE WHEN l_quantity > 10 THEN l_quantity END"),
            ("l_discount", "CASE WHEN l_discount > 0 THEN l_discount END"),
            ("l_tax", "l_tax"),
        )
    ),
)
def nulls_per_column(t):
    # Small values become null here, since the table has no nulls.
    lines = t.lineitem.select(
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("l_discount"),
        "l_tax",
    )
    return null_counts(lines)
