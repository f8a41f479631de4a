"""Schema, preview, inferred types, wide and long form, fills, codes, and checked models."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallymill.functions.columns import pearson, ratio_of_sums
from tallymill.operators.encode import impute, ordinal_encode
from tallymill.operators.models import kmeans_feature, pca
from tallymill.operators.reshape import pivot_table, unpivot
from tallymill.operators.windows import add_lags, add_rolling_means
from tallymill.plans.registry import iso, query, rounded
from tallymill.session import scratch_path, stored
from tallymill.sources.files import read_csv, write_csv
from tallymill.sources.tables import describe_schema, preview


@query(
    "schema_listing",
    """
    SELECT * FROM (VALUES (0, 'r_regionkey', 'int', true), (1, 'r_name', 'string', true))
        AS v(position, column_name, dtype, nullable)
    WHERE (SELECT count(*) FROM region) > 0
    """,
)
def schema_listing(t):
    """Columns of the region table, if it has rows."""
    some = t.region.agg(F.count(F.lit(1)) > 0).scalar()
    return describe_schema(t.region).where(some)


@query("preview_rows", "SELECT least(count(*), 5) AS shown, least(count(*), 5) AS known FROM supplier")
def preview_rows(t):
    """Any five suppliers: how many are shown, and how many of them the table knows."""
    shown = preview(t.supplier, 5)
    found = shown.join(t.supplier.select(F.col("s_suppkey").alias("_k")), F.col("s_suppkey") == F.col("_k"), "left")
    return found.agg(F.count(F.lit(1)).alias("shown"), F.count("_k").alias("known"))


@query(
    "csv_inferred",
    """
    SELECT r_name, count(*) AS nations, CAST(sum(n_nationkey) AS BIGINT) AS keys, true AS whole_numbers, '2024-01-01' AS first_day
    FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
    """,
)
def csv_inferred(t):
    """Nations written as CSV and read back with the types that the values show."""
    path = scratch_path(t.spark, "nations-csv")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_regionkey"))
    write_csv(t.nation.withColumn("day", day), path)
    back = read_csv(t.spark, path)
    kinds = dict(back.dtypes)
    whole = kinds["n_nationkey"] == "int" and kinds["day"] == "date"
    joined = back.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    start = back.agg(iso(F.min("day"))).scalar()
    return joined.groupBy("r_name").agg(
        F.count(F.lit(1)).alias("nations"),
        F.sum("n_nationkey").alias("keys"),
        F.lit(whole).alias("whole_numbers"),
        F.first(start).alias("first_day"),
    )


_STATUSES = ["F", "O", "P"]


@query(
    "wide_and_long",
    """
    SELECT o_orderpriority, o_orderstatus AS status, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY ALL
    """,
)
def wide_and_long(t):
    """Totals per priority with a column per status, and back to a row per status."""
    wide = pivot_table(t.orders, ["o_orderpriority"], "o_orderstatus", F.sum("o_totalprice"), _STATUSES)
    long = unpivot(wide, ["o_orderpriority"], _STATUSES, ("status", "total"))
    return rounded(long.where(F.col("total").isNotNull()), total=2)


@query(
    "imputed_events",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
                      CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type FROM events),
         m AS (SELECT quantile_cont(value, 0.5) AS v FROM e),
         k AS (SELECT event_type AS t FROM e WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT event_type, count(*) AS n, round(sum(value), 2) AS total
    FROM (SELECT coalesce(value, (SELECT v FROM m)) AS value, coalesce(event_type, (SELECT t FROM k)) AS event_type FROM e)
    GROUP BY event_type
    """,
)
def imputed_events(t):
    """Missing values filled by the median, missing types by the most frequent one."""
    holes = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
    )
    filled = impute(holes, {"value": "median", "event_type": "most_frequent"})
    out = filled.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(out, total=2)


@query(
    "priority_grades",
    """
    SELECT CAST(6 - substr(o_orderpriority, 1, 1)::INTEGER - 1 AS INTEGER) AS grade, count(*) AS n FROM orders GROUP BY 1
    """,
)
def priority_grades(t):
    """Orders per grade of their priority, 0 for the least urgent."""
    # The order priorities from least to most urgent.
    grades = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    coded = ordinal_encode(t.orders.select("o_orderpriority"), ["o_orderpriority"], grades)
    return coded.groupBy(F.col("o_orderpriority").alias("grade")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "discount_rate",
    """
    SELECT l_returnflag, round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 8) AS rate
    FROM lineitem GROUP BY l_returnflag
    """,
)
def discount_rate(t):
    """Discount given as a share of the price, per return flag."""
    given = ratio_of_sums(F.col("l_extendedprice") * F.col("l_discount"), F.col("l_extendedprice"))
    return rounded(t.lineitem.groupBy("l_returnflag").agg(given.alias("rate")), rate=8)


@query(
    "daily_lags",
    """
    WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, n, lag(n, 2) OVER w AS lag_2,
           CASE WHEN count(n) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) = 3
                THEN round(avg(n) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) END AS roll_3
    FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)
    """,
)
def daily_lags(t):
    """Events per type and day beside those of two days before and the mean of the last three."""
    days = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    lagged = add_lags(days, ["event_type"], ["day"], "n", [2])
    out = add_rolling_means(lagged, ["event_type"], ["day"], "n", [3])
    return rounded(out.withColumn("day", iso(F.col("day"))), roll_3=6)


@query(
    "corr_of_customer_counts",
    """
    SELECT round(corr(orders, value), 6) AS correlation FROM (
        SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS value FROM orders
        WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
    """,
)
def corr_of_customer_counts(t):
    """How a customer's number of orders goes with their value."""
    each = t.orders.where("o_custkey is not null").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_totalprice").alias("value")
    )
    return rounded(each.agg(pearson(F.col("orders"), F.col("value")).alias("correlation")), correlation=6)


@query(
    "cluster_conditions",
    "SELECT count(*) AS vectors, count(*) AS in_nearest, true AS centres_are_means FROM embeddings",
)
def cluster_conditions(t):
    """Every vector lies nearest to the mean of its own cluster, up to the fit's tolerance."""
    vectors = t.embeddings.select("vec_id", "embedding", array_to_vector("embedding").alias("vector"))
    out, _ = kmeans_feature(vectors, ["vector"], (5,), seed=0)
    rows = stored(out.select("vec_id", F.col("embedding"), "cluster"), "clusters")
    long = rows.select("vec_id", "cluster", F.posexplode("embedding").alias("i", "x"))
    # Distances are on z-scores, like the clusters.
    scale = long.groupBy("i").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s"))
    long = long.join(F.broadcast(scale), "i").select(
        "vec_id", "cluster", "i", F.coalesce(F.try_divide(F.col("x") - F.col("m"), F.col("s")), F.lit(0.0)).alias("z")
    )
    centres = long.groupBy("cluster", "i").agg(F.avg("z").alias("c")).withColumnRenamed("cluster", "other")
    apart = (
        long.join(F.broadcast(centres), "i")
        .groupBy("vec_id", "cluster", "other")
        .agg(F.sum((F.col("z") - F.col("c")) * (F.col("z") - F.col("c"))).alias("d"))
        .groupBy("vec_id")
        .agg(F.min("d").alias("least"), F.min(F.when(F.col("cluster") == F.col("other"), F.col("d"))).alias("own"))
    )
    # The fit stops when its centres move less than its tolerance, so a few rows may lie between two.
    near = F.col("own") <= F.col("least") * 1.02 + 1e-6
    return apart.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.count_if(near).alias("in_nearest"),
        (F.avg(F.col("own") - F.col("least")) < 1e-2).alias("centres_are_means"),
    )


_AXES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "component_conditions",
    """
    WITH c AS (SELECT unnest(range(1, 5)) AS k)
    SELECT 'PC' || a.k AS first, 'PC' || b.k AS second, CASE WHEN a.k = b.k THEN 1.0 ELSE 0.0 END::DOUBLE AS product,
           CASE WHEN a.k = b.k THEN 1.0 ELSE 0.0 END::DOUBLE AS covariance
    FROM c a JOIN c b ON a.k <= b.k WHERE (SELECT count(*) FROM lineitem) > 1
    """,
)
def component_conditions(t):
    """Components are orthonormal, and their scores uncorrelated with the explained variances."""
    scores, loadings, explained = pca(t.lineitem.select(*_AXES), _AXES)
    other = loadings.select(F.col("feature").alias("f"), F.col("component").alias("second"), F.col("loading").alias("l"))
    products = (
        loadings.withColumnRenamed("component", "first")
        .join(other, (F.col("feature") == F.col("f")) & (F.col("first") <= F.col("second")))
        .groupBy("first", "second")
        .agg(F.sum(F.col("loading") * F.col("l")).alias("product"))
    )
    s = vector_to_array("_scores")
    wide = scores.select(*[s[i].alias(f"s{i}") for i in range(len(_AXES))])
    pairs = [(i, j) for i in range(len(_AXES)) for j in range(i, len(_AXES))]
    cells = wide.agg(*[F.covar_samp(f"s{i}", f"s{j}").alias(f"c{i}_{j}") for i, j in pairs]).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f"PC{i + 1}").alias("a"),
                        F.lit(f"PC{j + 1}").alias("b"),
                        # A component's variance is its share of the number of z-scores.
                        (F.col(f"c{i}_{j}") / (explained[i] * len(_AXES))).alias("covariance"),
                    )
                    for i, j in pairs
                ]
            )
        )
    )
    out = products.join(cells, (F.col("first") == F.col("a")) & (F.col("second") == F.col("b")))
    return rounded(out.select("first", "second", "product", "covariance"), product=6, covariance=6)
