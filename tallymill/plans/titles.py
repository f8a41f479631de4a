"""Catalogue of titles: cleaning, content over time, shares, ends, durations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.functions.calendar import MONTH_NAMES
from tallymill.operators.aggregates import share
from tallymill.operators.cleaning import fill_mode
from tallymill.operators.ranking import order_by_labels
from tallymill.operators.stats import histogram, normal_fit
from tallymill.operators.windows import top_n_per_group
from tallymill.plans.registry import iso, query, rounded


@query(
    "content_by_year",
    """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS num_content
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def content_by_year(t):
    return (
        t.orders.where(F.col("o_orderstatus").isNotNull())
        .groupBy("o_orderstatus", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("num_content"))
        .orderBy("o_orderstatus", "year")
    )


@query(
    "content_share",
    """
    SELECT lang, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM documents), 6) AS share
    FROM documents WHERE lang IS NOT NULL GROUP BY lang
    """,
)
def content_share(t):
    return rounded(share(t.documents, ["lang"]), share=6)


@query(
    "release_years",
    """
    SELECT lang, source, count(*) AS num_content FROM documents
    WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def release_years(t):
    return (
        t.documents.na.drop("any", subset=["lang", "source"])
        .groupBy("lang", "source")
        .agg(F.count(F.lit(1)).alias("num_content"))
        .orderBy("lang", "source")
    )


@query(
    "content_by_month",
    """
    SELECT monthname(o_orderdate) AS month_name, o_orderstatus, count(*) AS num_content
    FROM orders GROUP BY 1, 2
    """,
)
def content_by_month(t):
    counted = t.orders.groupBy(
        F.date_format("o_orderdate", "MMMM").alias("month_name"), "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("num_content"))
    return order_by_labels(counted, "month_name", MONTH_NAMES, "o_orderstatus")


@query(
    "oldest_newest",
    """
    WITH r AS (SELECT lang, doc_id, n_chars,
                      row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS a,
                      row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS b
               FROM documents)
    SELECT 'shortest' AS kind, lang, doc_id, n_chars FROM r WHERE a <= 5
    UNION ALL SELECT 'longest', lang, doc_id, n_chars FROM r WHERE b <= 5
    """,
)
def oldest_newest(t):
    docs = t.documents.select("lang", "doc_id", "n_chars")
    short = top_n_per_group(docs, ["lang"], [F.asc("n_chars"), F.asc("doc_id")], 5)
    long = top_n_per_group(docs, ["lang"], [F.desc("n_chars"), F.asc("doc_id")], 5)
    return short.select(F.lit("shortest").alias("kind"), "*").unionByName(
        long.select(F.lit("longest").alias("kind"), "*")
    )


@query(
    "duration_fit",
    """
    WITH f AS (SELECT avg(l_quantity) AS mu, stddev_pop(l_quantity) AS sigma,
                      min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
         g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * (hi - lo) / 199 AS x, mu, sigma
               FROM f, range(200) AS r(i))
    SELECT i, round(x, 6) AS x, round(mu, 6) AS mu, round(sigma, 6) AS sigma,
           round(exp(-0.5 * ((x - mu) / sigma) ** 2) / (sigma * sqrt(2 * pi())), 8) AS density
    FROM g
    """,
)
def duration_fit(t):
    return rounded(normal_fit(t.lineitem, "l_quantity", 200), x=6, mu=6, sigma=6, density=8)


@query(
    "duration_histogram",
    """
    WITH m AS (SELECT CAST(replace(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || ' min', ' min', '') AS DOUBLE) AS v
               FROM lineitem),
         e AS (SELECT min(v) AS lo, (max(v) - min(v)) / 25 AS w, count(*) AS total FROM m),
         c AS (SELECT CAST(least(24, floor((v - lo) / w)) AS INTEGER) AS bin, count(*) AS n FROM m, e GROUP BY 1)
    SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * w, 6) AS bin_start,
           round(lo + (r.bin + 1) * w, 6) AS bin_end,
           coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * w), 8) AS density
    FROM range(25) AS r(bin) CROSS JOIN e LEFT JOIN c ON c.bin = r.bin
    """,
)
def duration_histogram(t):
    text = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" min"))
    minutes = F.replace(text, F.lit(" min"), F.lit("")).cast("double")
    out = histogram(t.lineitem.select(minutes.alias("minutes")), "minutes", bins=25, density=True)
    return rounded(out, bin_start=6, bin_end=6, density=8)


@query(
    "season_histogram",
    """
    WITH m AS (SELECT p_size AS v FROM part),
         e AS (SELECT min(v) AS lo, max(v) AS hi FROM m),
         c AS (SELECT CAST(least(hi - lo - 1, v - lo) AS INTEGER) AS bin, count(*) AS n FROM m, e GROUP BY 1)
    SELECT CAST(r.bin AS INTEGER) AS bin, (lo + r.bin)::DOUBLE AS bin_start,
           (lo + r.bin + 1)::DOUBLE AS bin_end, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(hi - lo)) AS bin, lo FROM e) r LEFT JOIN c ON c.bin = r.bin
    """,
)
def season_histogram(t):
    text = F.concat(F.col("p_size").cast("string"), F.lit(" Seasons"))
    seasons = F.regexp_extract(text, r"(\d+)", 1).cast("int")
    return histogram(t.part.select(seasons.alias("season")), "season", width=1)


@query(
    "rating_by_type",
    """
    SELECT quality, toxic, count(*) AS num_contents FROM labels GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def rating_by_type(t):
    return (
        t.labels.groupBy("quality", "toxic")
        .agg(F.count(F.lit(1)).alias("num_contents"))
        .orderBy("quality", "toxic")
    )


@query(
    "clean_titles",
    """
    WITH raw AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang,
                        CASE WHEN doc_id % 11 <> 0 THEN source END AS source,
                        CASE WHEN doc_id % 17 <> 0 THEN DATE '2015-01-01' + CAST(doc_id % 2000 AS INTEGER) END AS added
                 FROM documents),
         m AS (SELECT lang AS top FROM raw WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1),
         twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE doc_id % 13 = 0)
    SELECT DISTINCT doc_id, coalesce(lang, (SELECT lang AS top FROM twice WHERE lang IS NOT NULL
                                            GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang,
           coalesce(source, 'No data') AS source, strftime(added, '%Y-%m-%d') AS date_added,
           CAST(month(added) AS INTEGER) AS month, monthname(added) AS month_name,
           CAST(year(added) AS INTEGER) AS year
    FROM twice WHERE added IS NOT NULL
    """,
)
def clean_titles(t):
    # Nulls and repeated rows are put in, since the documents have none.
    key = F.col("doc_id")
    day = F.expr("date_add(date'2015-01-01', cast(doc_id % 2000 as int))")
    raw = t.documents.select(
        "doc_id",
        F.when(key % 7 != 0, F.col("lang")).alias("lang"),
        F.when(key % 11 != 0, F.col("source")).alias("source"),
        F.when(key % 17 != 0, F.concat(F.lit(" "), F.date_format(day, "MMMM d, yyyy"))).alias("date_added"),
    )
    raw = raw.unionByName(raw.where(key % 13 == 0))
    clean = fill_mode(raw, "lang").na.fill({"source": "No data"}).na.drop("any").dropDuplicates()
    parsed = F.to_date(F.trim("date_added"), "MMMM d, yyyy")
    return clean.withColumn("_d", parsed).select(
        "doc_id",
        "lang",
        "source",
        iso(F.col("_d")).alias("date_added"),
        F.month("_d").alias("month"),
        F.date_format("_d", "MMMM").alias("month_name"),
        F.year("_d").alias("year"),
    )
