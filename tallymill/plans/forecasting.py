"""Daily sales of each order priority and region: features, scores and forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallymill.functions.calendar import between_periods
from tallymill.functions.columns import align_columns
from tallymill.operators.cleaning import assert_output
from tallymill.operators.boosting import best_rounds, fit_boosted, lay_out
from tallymill.operators.forecast import (
    diagnose,
    fit_store_ridge,
    load_models,
    predict_all,
    predict_store_ridge,
    save_models,
    seasonal_fit_predict,
    time_split,
    train_all,
)
from tallymill.operators.reshape import dummy_name
from tallymill.operators.series import (
    PanelColumns,
    build_features,
    build_forecast_features,
    fill_panel,
    fit_spec,
)
from tallymill.operators.stats import (
    choose_policy,
    family_metrics,
    forecast_errors,
    pacf,
    series_sanity,
)
from tallymill.operators.windows import (
    autocorr,
    centered_mean,
    lag_of,
    series_window,
    trailing_mean,
)
from tallymill.plans.commerce import orders_with_place
from tallymill.plans.registry import iso, query, rounded
from tallymill.session import scratch_path, stored

_COLS = PanelColumns()
_KEYS = ["family", "store"]
_SPLIT = "2000-01-01"
_VALIDATION = "1999-01-01"
_STORES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

_PANEL_SQL = """
    WITH s AS (SELECT o_orderpriority AS family, r_name AS store, CAST(o_orderdate AS DATE) AS date,
                      round(sum(o_totalprice), 2) AS sales
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
         d AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM s),
         k AS (SELECT DISTINCT family, store FROM s),
         panel AS (SELECT k.family, k.store, d.date, coalesce(s.sales, 0.0) AS sales
                   FROM k CROSS JOIN d LEFT JOIN s ON s.family = k.family AND s.store = k.store AND s.date = d.date)
"""


def daily_panel(t):
    """Sales per priority, region and day, zero where nothing was sold."""
    sold = (
        orders_with_place(t)
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(
            F.col("o_orderpriority").alias("family"),
            F.col("r_name").alias("store"),
            F.to_date("o_orderdate").alias("date"),
        )
        .agg(F.round(F.sum("o_totalprice"), 2).alias("sales"))
    )
    # Filling asks for the ends, the series and the rows: three uses of one aggregation.
    return fill_panel(stored(sold, "sold"), _KEYS, "date", "sales")


def stored_panel(t):
    """The panel written once to the shared folder, for plans that read it many times."""
    return stored(daily_panel(t), "panel")


@query(
    "series_lags",
    _PANEL_SQL
    + """
    , f AS (SELECT *, lag(sales, 1) OVER w AS lag_1, lag(sales, 7) OVER w AS lag_7, lag(sales, 28) OVER w AS lag_28,
                   count(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS n7,
                   avg(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a7,
                   count(sales) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS n14,
                   avg(sales) OVER (w ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS a14
            FROM panel WINDOW w AS (PARTITION BY family, store ORDER BY date))
    SELECT family, store, strftime(date, '%Y-%m-%d') AS date, sales, lag_1, lag_7, lag_28,
           CASE WHEN n7 = 7 THEN round(a7, 4) END AS roll_7, CASE WHEN n14 = 14 THEN round(a14, 4) END AS roll_14,
           CAST(coalesce(lag_1 > 0, FALSE) OR coalesce(lag_7 > 0, FALSE) AS INTEGER) AS is_active FROM f
    """,
)
def series_lags(t):
    exprs = {f"lag_{k}": lag_of("sales", k) for k in (1, 7, 28)}
    exprs.update({f"roll_{w}": trailing_mean("sales", w) for w in (7, 14)})
    out = series_window(daily_panel(t), _KEYS, ["date"], exprs, before=28)
    active = F.coalesce(F.col("lag_1") > 0, F.lit(False)) | F.coalesce(F.col("lag_7") > 0, F.lit(False))
    out = out.withColumn("is_active", active.cast("int")).withColumn("date", iso(F.col("date")))
    return rounded(out, roll_7=4, roll_14=4)


@query(
    "centered_average",
    _PANEL_SQL
    + """
    , f AS (SELECT *, count(sales) OVER w AS n, avg(sales) OVER w AS a FROM panel
            WINDOW w AS (PARTITION BY family, store ORDER BY date ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING))
    SELECT family, store, strftime(date, '%Y-%m-%d') AS date, sales,
           CASE WHEN n >= 8 THEN round(a, 6) END AS centered_mean FROM f
    """,
)
def centered_average(t):
    out = centered_mean(daily_panel(t), _KEYS, ["date"], "sales", 14, 8)
    return rounded(out.withColumn("date", iso(F.col("date"))), centered_mean=6)


@query(
    "weekday_profile",
    _PANEL_SQL
    + """
    SELECT family, store, 'dayofweek' AS part, CAST(isodow(date) - 1 AS INTEGER) AS value, round(avg(sales), 6) AS mean_sales
    FROM panel GROUP BY ALL
    UNION ALL
    SELECT family, store, 'month', CAST(month(date) AS INTEGER), round(avg(sales), 6) FROM panel GROUP BY ALL
    """,
)
def weekday_profile(t):
    panel = daily_panel(t)
    # Sums per day part and month together first, so rows are not doubled before the shuffle.
    both = panel.groupBy(*_KEYS, F.weekday("date").alias("_w"), F.month("date").alias("_m")).agg(
        F.sum("sales").alias("s"), F.count("sales").alias("n")
    )
    cells = F.array(
        F.struct(F.lit("dayofweek").alias("part"), F.col("_w").alias("value")),
        F.struct(F.lit("month").alias("part"), F.col("_m").alias("value")),
    )
    out = (
        both.select(*_KEYS, F.inline(cells), "s", "n")
        .groupBy(*_KEYS, "part", "value")
        .agg((F.sum("s") / F.sum("n")).alias("mean_sales"))
    )
    return rounded(out, mean_sales=6)


@query(
    "series_sanity",
    _PANEL_SQL
    + """
    , f AS (SELECT family, count(*) FILTER (sales > 0)::DOUBLE / count(*) AS activity_ratio,
                   avg(sales) FILTER (sales > 0) AS m, stddev_samp(sales) FILTER (sales > 0) AS s
            FROM panel GROUP BY family)
    SELECT family, round(activity_ratio, 6) AS activity_ratio, round(m, 4) AS mean_sales_active,
           round(s, 4) AS std_sales_active, round(s / m, 6) AS cv_active, activity_ratio < 0.1 AS flag_sparsity,
           m > (SELECT avg(m) + stddev_samp(m) FROM f) AS flag_high_sales, s / m > 1 AS flag_high_volatility
    FROM f
    """,
)
def family_sanity(t):
    out = series_sanity(daily_panel(t), "family", "sales")
    return rounded(out, activity_ratio=6, mean_sales_active=4, std_sales_active=4, cv_active=6)


@query(
    "series_pacf",
    _PANEL_SQL.replace("WITH s AS", "WITH RECURSIVE s AS", 1)
    + """
    , x AS (SELECT family, store, row_number() OVER (PARTITION BY family, store ORDER BY date) AS t,
                   sales - avg(sales) OVER (PARTITION BY family, store) AS v,
                   count(*) OVER (PARTITION BY family, store) AS n FROM panel),
      h AS (SELECT CAST(unnest(range(13)) AS INTEGER) AS lag),
      g AS (SELECT a.family, a.store, lag, sum(a.v * b.v) / max(a.n) AS c
            FROM x a CROSS JOIN h JOIN x b ON b.family = a.family AND b.store = a.store AND b.t = a.t - lag
            GROUP BY ALL),
      c AS (SELECT family, store, list(c ORDER BY lag) AS gamma FROM g GROUP BY ALL),
      p AS (SELECT family, store, gamma, 0 AS k, CAST([] AS DOUBLE[]) AS phi, gamma[1] AS var, 1.0::DOUBLE AS a FROM c
            UNION ALL
            SELECT family, store, gamma, k, list_append(list_transform(range(1, k), lambda j: phi[j] - a * phi[k - j]), a),
                   var * (1 - a * a), a
            FROM (SELECT family, store, gamma, k + 1 AS k, phi, var,
                         (gamma[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * gamma[k - j + 2])), 0)) / var AS a
                  FROM p WHERE k < 12))
    SELECT family, store, k AS lag, round(a, 8) AS pacf FROM p
    """,
)
def series_pacf(t):
    return rounded(pacf(daily_panel(t), _KEYS, ["date"], "sales", 12), pacf=8)


def _dummy_sql(slopes: bool) -> str:
    cells = [f"CAST(isodow(date) - 1 = {v} AS INTEGER) AS {dummy_name('dayofweek', v)}" for v in range(1, 7)]
    cells += [f"CAST(month(date) = {v} AS INTEGER) AS {dummy_name('month', v)}" for v in range(2, 13)]
    for v in _STORES[1:]:
        cells.append(f"CAST(store = '{v}' AS INTEGER) AS {dummy_name('store', v)}")
        if slopes:
            cells.append(
                f"CASE WHEN store = '{v}' THEN time_idx ELSE 0 END AS {dummy_name('store', v)}_time"
            )
    return ", ".join(cells)


@query(
    "panel_features",
    _PANEL_SQL
    + """
    , i AS (SELECT family, date, CAST(row_number() OVER (PARTITION BY family ORDER BY date) - 1 AS INTEGER) AS time_idx
            FROM (SELECT DISTINCT family, date FROM panel)),
      f AS (SELECT panel.*, time_idx, lag(sales, 1) OVER w AS lag_1, lag(sales, 7) OVER w AS lag_7,
                   lag(sales, 28) OVER w AS lag_28,
                   avg(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS roll_7
            FROM panel JOIN i ON i.family = panel.family AND i.date = panel.date
            WINDOW w AS (PARTITION BY panel.family, store ORDER BY panel.date))
    SELECT family, store, strftime(date, '%Y-%m-%d') AS date, sales, lag_1, lag_7, lag_28, round(roll_7, 4) AS roll_7,
           CAST(lag_1 > 0 OR lag_7 > 0 AS INTEGER) AS is_active, CAST(year(date) AS INTEGER) AS year,
           time_idx, 0 AS store_UNSEEN,
    """
    + _dummy_sql(True)
    + " FROM f WHERE lag_28 IS NOT NULL",
)
def panel_features(t):
    panel = daily_panel(t)
    spec = fit_spec(panel, _COLS, (1, 7, 28), (7,))
    out = build_features(panel, (1, 7, 28), (7,), _COLS, spec)
    kept = ["family", "store", "date", "sales", "lag_1", "lag_7", "lag_28", "roll_7", "is_active", "year"]
    out = align_columns(out, [*spec.linear_columns(), "store_UNSEEN"], 0, kept)
    return rounded(out.withColumn("date", iso(F.col("date"))), roll_7=4)


@query(
    "forecast_scores",
    _PANEL_SQL
    + """
    , f AS (SELECT *, lag(sales, 7) OVER w AS a, avg(sales) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS b
            FROM panel WINDOW w AS (PARTITION BY family, store ORDER BY date)),
      v AS (SELECT *, sales - a AS r FROM f WHERE a IS NOT NULL),
      test AS (SELECT * FROM v WHERE date >= DATE '2000-01-01'),
      m AS (SELECT family, avg(abs(sales - a)) AS lr_mae, avg(abs(sales - b)) AS hybrid_mae,
                   avg(abs(b - a)) / (avg(abs(a)) + 1e-8) AS xgb_contrib_ratio,
                   1 - var_pop(r - (b - a)) / var_pop(r) AS explained_frac FROM test GROUP BY family),
      e AS (SELECT family, store, avg(abs(sales - a)) AS am, avg(abs(sales - b)) AS bm,
                   100 * avg(2 * abs(sales - a) / (abs(sales) + abs(a) + 1e-8)) AS asm,
                   100 * avg(2 * abs(sales - b) / (abs(sales) + abs(b) + 1e-8)) AS bsm FROM test GROUP BY ALL),
      es AS (SELECT family, avg(am) AS lag_mae, avg(asm) AS lag_smape, avg(bm) AS mean_mae, avg(bsm) AS mean_smape
             FROM e GROUP BY family),
      l AS (SELECT family, store, r, lag(r) OVER (PARTITION BY family ORDER BY store, date) AS flat,
                   lag(r) OVER (PARTITION BY family, store ORDER BY date) AS own FROM v),
      c AS (SELECT family, corr(r, flat) AS mean_residual_acf FROM l GROUP BY family),
      cs AS (SELECT family, avg(x) AS store_residual_acf
             FROM (SELECT family, store, corr(r, own) AS x FROM l GROUP BY ALL) GROUP BY family)
    SELECT family, round(lr_mae, 4) AS lr_mae, round(hybrid_mae, 4) AS hybrid_mae,
           round(xgb_contrib_ratio, 6) AS xgb_contrib_ratio, round(explained_frac, 6) AS explained_frac,
           round((lr_mae - hybrid_mae) / lr_mae * 100, 6) AS mae_improvement_pct,
           round(lag_mae, 4) AS lag_mae, round(lag_smape, 6) AS lag_smape, round(mean_mae, 4) AS mean_mae,
           round(mean_smape, 6) AS mean_smape, round(mean_residual_acf, 6) AS mean_residual_acf,
           round(store_residual_acf, 6) AS store_residual_acf,
           CASE WHEN explained_frac < 0.05 OR (lr_mae - hybrid_mae) / lr_mae * 100 < 5 THEN 'lr' ELSE 'hybrid' END AS policy
    FROM m JOIN es USING (family) JOIN c USING (family) JOIN cs USING (family)
    """,
)
def forecast_scores(t):
    exprs = {"a": lag_of("sales", 7), "b": trailing_mean("sales", 7)}
    rows = series_window(stored_panel(t), _KEYS, ["date"], exprs, before=7).where(
        F.col("a").isNotNull()
    )
    rows = rows.withColumn("shift", F.col("b") - F.col("a")).withColumn("r", F.col("sales") - F.col("a"))
    rows = stored(rows, "forecast-rows")
    _, test = time_split(rows, "date", _SPLIT)
    tables = [
        family_metrics(test, ["family"], "sales", "a", "b", "shift"),
        forecast_errors(test, "sales", {"lag": "a", "mean": "b"}, ["store"], ["family"]),
        autocorr(rows, ["family"], ["store"], "date", "r", flat=True, name="mean_residual_acf"),
        autocorr(rows, ["family"], ["store"], "date", "r", name="store_residual_acf"),
    ]
    out = choose_policy(reduce(lambda x, y: x.join(y, "family"), tables))
    return rounded(
        out,
        lr_mae=4, hybrid_mae=4, xgb_contrib_ratio=6, explained_frac=6, mae_improvement_pct=6,
        lag_mae=4, lag_smape=6, mean_mae=4, mean_smape=6, mean_residual_acf=6, store_residual_acf=6,
    )


@query("seasonal_forecast")
def seasonal_forecast(t):
    """Seasonal regression on the year 2000, 16 days ahead, ids of the asked rows joined back."""
    panel = stored_panel(t)
    ahead = seasonal_fit_predict(between_periods(panel, "date", "2000", "2000"), _KEYS, "date", "sales", 16)
    asked = between_periods(panel, "date", "2001-01-01", "2001-01-16").select(
        "store", "family", "date",
        F.concat_ws("/", "store", "family", iso(F.col("date"))).alias("id"),
    )
    out = ahead.join(asked, ["store", "family", "date"], "left")
    return rounded(
        out.select("id", "family", "store", iso(F.col("date")).alias("date"), F.col("prediction").alias("sales")),
        sales=4,
    )


_GRID = {"maxDepth": [2, 4], "stepSize": [0.1], "maxIter": [8], "minInstancesPerNode": [5]}


@query("hybrid_forecast")
def hybrid_forecast(t):
    """Metrics and policy of the ridge plus boosted-residual forecast, per family."""
    _, metrics, _ = diagnose(stored_panel(t), _SPLIT, _VALIDATION, grid=_GRID)
    return metrics


@query("family_forecast")
def family_forecast(t):
    """Diagnose, train, save, load and predict the last weeks, with the output checks."""
    panel = stored_panel(t)
    train, future = time_split(panel, "date", "2001-07-17")
    first = {"maxDepth": [3], "stepSize": [0.1], "maxIter": [8], "minInstancesPerNode": [5]}
    _, metrics, best = diagnose(train, _SPLIT, _VALIDATION, grid=first)
    policies = {r["family"]: r["policy"] for r in metrics.select("family", "policy").collect()}
    path = scratch_path(t.spark, "family-models")
    save_models(train_all(train, policies, best), path)
    asked = future.drop("sales")
    out = stored(predict_all(asked, load_models(t.spark, path)), "family-forecast")
    assert_output(out, asked.count(), "sales")
    return rounded(out.withColumn("date", iso(F.col("date"))), sales=4).orderBy("family", "store", "date")


_STUMP_PARTS = {"dayofweek": "isodow(date) - 1", "month": "month(date)", "dayofmonth": "day(date)"}
_STUMP_LONG = " UNION ALL ".join(
    f"SELECT family, '{name}' AS feature, {i} AS f, CAST({sql} AS DOUBLE) AS x, sales FROM panel"
    for i, (name, sql) in enumerate(_STUMP_PARTS.items())
)


@query(
    "family_stumps",
    _PANEL_SQL
    + f"""
    , long AS ({_STUMP_LONG}),
      g AS (SELECT family, feature, f, x, count(*) AS n, sum(sales) AS s FROM long GROUP BY ALL),
      c AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER a AS nt, sum(s) OVER a AS st,
                   lead(x) OVER w AS nx
            FROM g WINDOW w AS (PARTITION BY family, f ORDER BY x), a AS (PARTITION BY family, f)),
      v AS (SELECT *, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM c WHERE nx IS NOT NULL)
    SELECT family, feature, (x + nx) / 2 AS threshold, round(sl / nl, 4) AS left_mean,
           round((st - sl) / (nt - nl), 4) AS right_mean
    FROM v QUALIFY row_number() OVER (PARTITION BY family ORDER BY gain DESC, f, x) = 1
    """,
)
def family_stumps(t):
    """The best single split of every family's sales by the parts of the date, all families at once."""
    parts = {"dayofweek": F.weekday("date"), "month": F.month("date"), "dayofmonth": F.dayofmonth("date")}
    rows = stored_panel(t).withColumns(parts)
    setting = {"maxDepth": 1, "maxIter": 1, "stepSize": 1.0}
    chunks = lay_out(rows, ["family"], list(parts), "sales", ["store", "date"])
    models = stored(best_rounds(fit_boosted(chunks, ["family"], [setting]), ["family"]), "stumps")
    nodes = models.select("family", "base", F.col("trees").alias("n"))

    def value(node):
        return F.element_at(F.filter("n", lambda x: (x["node"] == node) & (x["feature"] < 0)), 1)["value"]

    split = F.element_at(F.filter("n", lambda x: (x["node"] == 1) & (x["feature"] >= 0)), 1)
    names = F.array(*[F.lit(p) for p in parts])
    out = nodes.select(
        "family",
        F.get(names, split["feature"]).alias("feature"),
        split["threshold"].alias("threshold"),
        (F.col("base") + value(2)).alias("left_mean"),
        (F.col("base") + value(3)).alias("right_mean"),
    )
    return rounded(out, left_mean=4, right_mean=4)


@query(
    "store_ridge_gradient",
    _PANEL_SQL
    + """
    SELECT family, store, count(*) AS days, 0.0::DOUBLE AS intercept, 0.0::DOUBLE AS time_idx, 0.0::DOUBLE AS weekday_2,
           0.0::DOUBLE AS month_7, 0.0::DOUBLE AS store_offset, 0.0::DOUBLE AS store_slope
    FROM panel GROUP BY family, store
    """,
)
def store_ridge_gradient(t):
    """What is left of the normal equations of the families' ridge, a share of their size: nothing.

    The gradient X'(y - Xb) - alpha b is 0 for the offset and slope of every store and for
    the features that a family's stores share. The first store has none of its own.
    """
    alpha = 4.0
    panel = stored_panel(t)
    spec = fit_spec(panel, _COLS, wide=False)
    rows = stored(build_forecast_features(panel, spec, None, _COLS), "ridge-rows")
    ridge = fit_store_ridge(rows, spec, _COLS, alpha)
    shared = spec.shared_columns()
    kept = {"time_idx": "time_idx", "weekday_2": dummy_name("dayofweek", 2), "month_7": dummy_name("month", 7)}
    left = predict_store_ridge(rows, ridge, spec, _COLS, "_p").withColumn("_r", F.col("sales") - F.col("_p"))
    left = left.withColumn("_1", F.lit(1))
    both = {"intercept": "_1", **kept, "store_offset": "store_own", "store_slope": "store_time"}
    sums = left.groupBy("family", "store").agg(
        F.count(F.lit(1)).alias("days"),
        *[F.sum(F.col(c) * F.col("_r")).alias(f"g_{n}") for n, c in both.items()],
        *[F.sum(F.abs(F.col(c) * F.col("_r"))).alias(f"s_{n}") for n, c in both.items()],
    )
    whole = sums.groupBy("family").agg(
        *[F.sum(f"{k}_{n}").alias(f"{k}_all_{n}") for n in ("intercept", *kept) for k in ("g", "s")]
    )
    found = (
        sums.join(whole, "family")
        .join(ridge[0].select("family", "coef"), "family")
        .join(ridge[1], ["family", "store"])
    )

    def rest(gradient: str, size: str, penalty):
        return F.try_divide(F.col(gradient) - penalty, F.greatest(F.col(size), F.lit(1.0)))

    pull = {n: F.get("coef", F.lit(shared.index(c))) * alpha for n, c in kept.items()}
    out = found.select(
        "family",
        "store",
        "days",
        rest("g_all_intercept", "s_all_intercept", F.lit(0.0)).alias("intercept"),
        *[rest(f"g_all_{n}", f"s_all_{n}", p).alias(n) for n, p in pull.items()],
        rest("g_store_offset", "s_store_offset", F.get("own_coef", F.lit(0)) * alpha).alias("store_offset"),
        rest("g_store_slope", "s_store_slope", F.get("own_coef", F.lit(1)) * alpha).alias("store_slope"),
    )
    return rounded(out, intercept=6, time_idx=6, weekday_2=6, month_7=6, store_offset=6, store_slope=6)
