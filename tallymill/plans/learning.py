"""Feature scores, encoders, tree models, clusters and components."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallymill.functions.columns import combine_columns, count_positive, ratio_features
from tallymill.operators.cleaning import (
    columns_of_type,
    keep_dense_columns,
    low_cardinality_columns,
)
from tallymill.operators.encode import (
    factorize,
    m_estimate_encode,
    standardize,
    target_encoding,
)
from tallymill.operators.labels import label_counts, label_index, one_hot_vectors, with_codes
from tallymill.operators.models import (
    TablePreprocessor,
    feature_importance,
    fit_boosted,
    fit_forest,
    grid_search,
    kmeans_feature,
    pca,
    predict,
)
from tallymill.operators.reshape import dummies, fit_labels, interaction
from tallymill.operators.stats import high_corr_features, mutual_information
from tallymill.operators.windows import group_stat_feature
from tallymill.plans.registry import query, rounded
from tallymill.session import scratch_path, stored
from tallymill.sources.files import read_csv, write_csv

_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "target_encoded",
    """
    WITH train AS (SELECT * FROM part WHERE p_size <= 40),
         s AS (SELECT p_brand, sum(p_retailprice) AS s, count(p_retailprice) AS n FROM train
               WHERE p_brand <> 'Brand#7' GROUP BY p_brand),
         prior AS (SELECT avg(p_retailprice) AS p FROM train WHERE p_brand <> 'Brand#7')
    SELECT p_partkey, p_brand, round(coalesce((s + 5 * p) / (n + 5), p), 4) AS brand_price
    FROM part LEFT JOIN s USING (p_brand) CROSS JOIN prior
    """,
)
def target_encoded(t):
    # Brand 7 is left out of training, so its rows are an unseen category.
    train = t.part.where((F.col("p_size") <= 40) & (F.col("p_brand") != "Brand#7"))
    out = m_estimate_encode(train, t.part, "p_brand", "p_retailprice", "brand_price", 5.0)
    return rounded(out.select("p_partkey", "p_brand", "brand_price"), brand_price=4)


@query(
    "holdout_encode",
    """
    WITH b AS (SELECT *, ('0x' || substr(md5(p_partkey || '|' || '7'), 1, 8))::BIGINT % 100 < 20 AS held FROM part),
         s AS (SELECT p_brand, sum(p_retailprice) AS s, count(*) AS n FROM b WHERE held GROUP BY p_brand),
         prior AS (SELECT avg(p_retailprice) AS p FROM b WHERE held)
    SELECT p_partkey, round(coalesce((s + 5 * p) / (n + 5), p), 4) AS brand_price
    FROM b LEFT JOIN s USING (p_brand) CROSS JOIN prior WHERE NOT held
    """,
)
def holdout_encode(t):
    out = target_encoding(t.part, "p_brand", "p_retailprice", ["p_partkey"], 7, name="brand_price")
    return rounded(out.select("p_partkey", "brand_price"), brand_price=4)


@query(
    "impute_and_encode",
    """
    WITH raw AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS buyer,
                        CASE WHEN o_orderkey % 8 <> 0 THEN o_orderstatus END AS status,
                        CASE WHEN o_orderkey % 6 <> 0 THEN o_orderpriority END AS grade,
                        o_orderkey % 5 = 0 AS fifth
                 FROM orders),
         m AS (SELECT median(buyer) AS buyer, avg(o_totalprice) AS prior,
                      (SELECT status FROM raw WHERE status IS NOT NULL GROUP BY status ORDER BY count(*) DESC, status LIMIT 1) AS status
               FROM raw),
         d AS (SELECT DISTINCT status FROM raw WHERE status IS NOT NULL),
         f AS (SELECT fifth, (sum(o_totalprice) + 5 * avg(prior)) / (count(*) + 5) AS mean FROM raw, m GROUP BY fifth)
    SELECT o_orderkey, coalesce(raw.buyer::DOUBLE, m.buyer) AS buyer,
           (SELECT string_agg((d.status = coalesce(raw.status, m.status))::INTEGER::VARCHAR, ',' ORDER BY d.status) FROM d) AS status,
           (list_position(['Missing', '5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT'],
                          coalesce(grade, 'Missing')) - 1)::DOUBLE AS grade_grade, round(f.mean, 4) AS fifth_mean
    FROM raw, m JOIN f ON f.fifth = raw.fifth
    """,
)
def impute_and_encode(t):
    # Nulls are put in, since the orders have none; one column is null throughout.
    key = F.col("o_orderkey")
    raw = t.orders.select(
        "o_orderkey",
        F.when(key % 9 != 0, F.col("o_custkey")).alias("buyer"),
        F.when(key % 8 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 6 != 0, F.col("o_orderpriority")).alias("grade"),
        (key % 5 == 0).alias("fifth"),
        F.lit(None).cast("double").alias("empty"),
        "o_totalprice",
    )
    dense = keep_dense_columns(raw, raw.count())
    # The order priorities from least to most urgent.
    grades = ["Missing", "5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
    prepared = TablePreprocessor.of(
        {
            "median": [c for c in columns_of_type(dense, "number") if c == "buyer"],
            "one_hot": ["status"],
            "ordinal": {"grade": {"grades": grades, "fill": "Missing"}},
            "target": {"columns": ["fifth"], "label": "o_totalprice", "m": 5.0},
        }
    ).fit(dense)
    wide = prepared.encode(dense, ["o_orderkey"])
    made = [c for c in prepared.feature_names() if c.startswith("status_")]
    joined = F.concat_ws(",", *[F.col(c).cast("int") for c in made])
    return rounded(wide.withColumn("status", joined).drop(*made), fifth_mean=4)


def _mi_sql() -> str:
    def cut(c):
        return (
            f"least(9, floor(({c} - (SELECT min({c}) FROM lineitem)) * 10 / "
            f"((SELECT max({c}) FROM lineitem) - (SELECT min({c}) FROM lineitem))))::VARCHAR"
        )

    parts = []
    for c in ("l_quantity", "l_discount", "l_returnflag"):
        x = c if c == "l_returnflag" else cut(c)
        parts.append(
            f"SELECT '{c}' AS feature, {x} AS x, {cut('l_extendedprice')} AS y FROM lineitem"
        )
    return f"""
    WITH long AS ({' UNION ALL '.join(parts)}),
         j AS (SELECT feature, x, y, count(*)::DOUBLE AS n FROM long GROUP BY ALL),
         p AS (SELECT *, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny,
                      sum(n) OVER (PARTITION BY feature) AS nn FROM j)
    SELECT feature, round(sum(n / nn * ln(n * nn / (nx * ny))), 8) AS mi_score FROM p GROUP BY feature
    """


@query("mi_scores", _mi_sql())
def mi_scores(t):
    out = mutual_information(
        t.lineitem, ["l_quantity", "l_discount", "l_returnflag"], "l_extendedprice", 10
    )
    return rounded(out, mi_score=8)


@query(
    "high_corr",
    """
    SELECT * FROM (
      SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
      UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM lineitem
      UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM lineitem
      UNION ALL SELECT 'per_unit', round(corr(l_extendedprice / l_quantity, l_extendedprice), 6) FROM lineitem)
    WHERE abs(corr) > 0.002
    """,
)
def high_corr(t):
    lines = t.lineitem.select(
        *_NUMERIC, (F.col("l_extendedprice") / F.col("l_quantity")).alias("per_unit")
    )
    out = high_corr_features(lines, "l_extendedprice", columns_of_type(lines, "number"), 0.0)
    return rounded(out, corr=6).where(F.abs("corr") > 0.002)


@query(
    "area_features",
    """
    WITH p AS (SELECT *, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS big FROM part)
    SELECT p_partkey, round(p_retailprice / p_size, 6) AS price_per_size, round(p_retailprice + p_size, 4) AS total,
           CAST(p_retailprice > 0 AS INTEGER) + CAST(big > 0 AS INTEGER) AS n_positive,
           round(avg(p_retailprice) OVER (PARTITION BY p_brand), 4) AS brand_mean,
           """
    + """(SELECT string_agg((CASE WHEN p.p_type = d.p_type THEN p.p_size ELSE 0 END)::VARCHAR, ',' ORDER BY d.p_type)
             FROM (SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL) d) AS size_by_type
    FROM p""",
)
def area_features(t):
    parts = t.part.withColumn("big", F.when(F.col("p_size") > 10, F.col("p_size")).otherwise(0))
    out = ratio_features(
        parts,
        {"price_per_size": (["p_retailprice"], ["p_size"]), "total": (["p_retailprice", "p_size"], None)},
    )
    out = count_positive(out, ["p_retailprice", "big"], "n_positive")
    # One interaction column per type that the table has, shown in the order of the types.
    labels = fit_labels(t.part, ["p_type"])["p_type"]
    out = interaction(out, "p_type", "p_size", labels)
    out = group_stat_feature(out, "p_brand", "p_retailprice", F.avg, "brand_mean")
    out = out.withColumn("size_by_type", F.concat_ws(",", *[F.col(f"`{n}`") for n in dummies("p_type", labels)]))
    kept = ["p_partkey", "price_per_size", "total", "n_positive", "brand_mean", "size_by_type"]
    return rounded(out.select(*kept), price_per_size=6, total=4, brand_mean=4)


@query(
    "typed_columns",
    """
    WITH d AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_code
               FROM (SELECT DISTINCT p_type FROM part)),
         n AS (SELECT p_name, CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name_code
               FROM (SELECT DISTINCT p_name FROM part))
    SELECT p_partkey, p_size, p_type, p_type_code, p_name_code FROM part JOIN d USING (p_type) JOIN n USING (p_name)
    """,
)
def typed_columns(t):
    # Numbers, the text columns with fewer than ten values, and codes of two texts.
    small = low_cardinality_columns(t.part, 10)
    out = factorize(factorize(t.part, "p_type", "p_type_code"), "p_name", "p_name_code")
    numbers = [c for c in columns_of_type(t.part, "number") if c != "p_retailprice"]
    return out.select(*numbers, *small, "p_type_code", "p_name_code")


@query(
    "scaled_columns",
    """
    WITH s AS (SELECT avg(p_retailprice) AS mp, stddev_samp(p_retailprice) AS sp,
                      avg(p_size) AS ms, stddev_samp(p_size) AS ss FROM part)
    SELECT p_partkey, round((p_retailprice - mp) / sp + (p_size - ms) / ss, 6) + 0.0 AS combined FROM part, s
    """,
)
def scaled_columns(t):
    scaled = standardize(t.part, ["p_retailprice", "p_size"])
    out = combine_columns(scaled, ["p_retailprice", "p_size"], "combined")
    return rounded(out.select("p_partkey", "combined"), combined=6)


def _priced_parts(t):
    """Parts with their sales, the rows of the price models."""
    sold = t.lineitem.groupBy("l_partkey").agg(
        F.avg("l_extendedprice").alias("avg_line"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("discount"),
    )
    return t.part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        "p_partkey", "p_brand", "p_type", "p_size", "avg_line", "quantity", "discount", "p_retailprice"
    )


_SPEC = {
    "median": ["p_size", "avg_line", "quantity", "discount"],
    "one_hot": ["p_type"],
    "target": {"columns": ["p_brand"], "label": "p_retailprice", "m": 5.0},
}


def _search(t, fit, grid, folds):
    parts = stored(_priced_parts(t), "priced-parts")
    return parts, grid_search(
        parts, TablePreprocessor.of(_SPEC), fit, grid, "p_retailprice", ["p_partkey"], folds
    )


@query("forest_cv")
def forest_cv(t):
    """Random forest chosen by five-fold error; predictions written as CSV and returned."""
    grid = {"numTrees": [10], "minInstancesPerNode": [3, 7], "featureSubsetStrategy": ["0.7"]}
    parts, found = _search(t, fit_forest, grid, 5)
    out = predict(found, parts, ["p_partkey"], "predicted")
    path = scratch_path(t.spark, "forest-predictions")
    write_csv(out, path)
    return read_csv(t.spark, path, "p_partkey bigint, predicted double")


@query("boosted_cv")
def boosted_cv(t):
    """Boosted trees chosen by five-fold error; predictions of every part."""
    grid = {"maxIter": [5], "maxDepth": [3, 4], "stepSize": [0.1], "minInstancesPerNode": [3]}
    parts, found = _search(t, fit_boosted, grid, 5)
    return predict(found, parts, ["p_partkey"], "predicted")


@query("importance_table")
def importance_table(t):
    """Importances of a forest beside the correlation of each numeric feature."""
    parts = stored(_priced_parts(t), "priced-parts")
    prepared = TablePreprocessor.of(_SPEC).fit(parts)
    model = fit_forest(
        prepared.transform(parts), "p_retailprice", {"numTrees": 10, "minInstancesPerNode": 3}
    )
    numeric = prepared.encode(parts, ["p_retailprice"])
    correlations = high_corr_features(numeric, "p_retailprice", prepared.feature_names(), -1.0)
    return feature_importance(parts, model, prepared.feature_names(), correlations)


@query("kmeans_feature")
def clustered_vectors(t):
    """Cluster of every embedding, number of clusters chosen by silhouette."""
    vectors = t.embeddings.select("vec_id", "label", array_to_vector("embedding").alias("vector"))
    out, _ = kmeans_feature(vectors, ["vector"], (5, 15), seed=0)
    return out.select("vec_id", "label", "cluster")


@query("pca_loadings")
def pca_loadings(t):
    """Loadings of the line item numbers, with the explained share of each component."""
    _, loadings, explained = pca(t.lineitem.select(*_NUMERIC), _NUMERIC)
    shares = F.create_map(*[F.lit(x) for i, v in enumerate(explained) for x in (f"PC{i + 1}", v)])
    return loadings.withColumn("explained", F.element_at(shares, F.col("component")))


@query(
    "pca_scores",
    """
    WITH z AS (SELECT p_partkey, (p_size - avg(p_size) OVER ()) / stddev_samp(p_size) OVER () AS a,
                      (p_retailprice - avg(p_retailprice) OVER ()) / stddev_samp(p_retailprice) OVER () AS b FROM part),
         r AS (SELECT sign(corr(a, b)) AS s FROM z)
    SELECT p_partkey, round((a + s * b) / sqrt(2), 6) + 0.0 AS pc1, round((a - s * b) / sqrt(2), 6) + 0.0 AS pc2 FROM z, r
    """,
)
def pca_scores(t):
    """Both component scores of every part; of two z-scores these are their sum and difference."""
    out, _, _ = pca(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    scores = vector_to_array("_scores")
    return rounded(out.select("p_partkey", scores[0].alias("pc1"), scores[1].alias("pc2")), pc1=6, pc2=6)


@query(
    "label_codes",
    """
    SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS type_code,
           CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS name_code,
           CAST(p_type IN (SELECT p_type FROM part WHERE p_size <= 25) AS INTEGER) AS known_type
    FROM part
    """,
)
def label_codes(t):
    """The number of each part's type and name, and whether a vector from small parts knows the type."""
    index = label_index(t.part, ["p_type", "p_name"])
    coded = with_codes(t.part.select("p_partkey", "p_type", "p_name"), index, ["p_type", "p_name"])
    small = label_index(t.part.where("p_size <= 25"), ["p_type"])
    seen = one_hot_vectors(coded, small, label_counts(small, ["p_type"]))
    # An unknown label is a vector without an entry.
    return seen.select(
        "p_partkey",
        F.col("p_type_code").alias("type_code"),
        F.col("p_name_code").alias("name_code"),
        F.aggregate(vector_to_array("p_type_vector"), F.lit(0.0), lambda a, x: a + x).cast("int").alias("known_type"),
    )
