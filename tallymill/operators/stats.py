"""Distribution, correlation and dependence statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymill.functions.columns import let, pearson
from tallymill.functions.scalars import totals
from tallymill.operators.quantiles import exact_quantiles
from tallymill.operators.windows import lag_of, series_window


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long form; each pair skips its own nulls.

    Each unordered pair is computed once and all of them in one aggregation.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[pearson(F.col(a), F.col(b)).alias(f"_{a}|{b}") for a, b in pairs])
    cells = []
    for a in cols:
        for b in cols:
            held = f"`_{a}|{b}`" if (a, b) in set(pairs) else f"`_{b}|{a}`"
            cells.append(
                F.struct(F.lit(a).alias("col_x"), F.lit(b).alias("col_y"), F.col(held).alias("corr"))
            )
    return one.select(F.inline(F.array(*cells)))


def high_corr_features(
    df: DataFrame, target: str, cols: Sequence[str], lower_bound: float = 0.25
) -> DataFrame:
    """Columns whose correlation with ``target`` exceeds the bound in size, largest first."""
    cols = [c for c in cols if c != target]
    one = df.agg(*[pearson(F.col(c), F.col(target)).alias(c) for c in cols])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols]
    return (
        one.select(F.inline(F.array(*cells)))
        .where(F.abs("corr") > lower_bound)
        .orderBy(F.desc("corr"), "feature")
    )


def normal_fit(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Maximum-likelihood normal density on an even grid from minimum to maximum."""
    fitted = df.agg(
        F.avg(col).alias("mu"),
        F.stddev_pop(col).alias("sigma"),
        F.min(col).cast("double").alias("lo"),
        F.max(col).cast("double").alias("hi"),
    )
    x = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1)
    z = F.try_divide(F.col("x") - F.col("mu"), F.col("sigma"))
    return (
        fitted.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", x)
        .select(
            "i",
            "x",
            "mu",
            "sigma",
            F.try_divide(F.exp(z * z * -0.5), F.col("sigma") * math.sqrt(2 * math.pi)).alias("density"),
        )
    )


def histogram(
    df: DataFrame, col: str, bins: int | None = None, width: float | None = None, density: bool = False
) -> DataFrame:
    """Counts of even bins from minimum to maximum, last bin closed, empty bins kept.

    Give the number of bins or their width. With a single value the only range is
    half a unit to both sides.
    """
    if (bins is None) == (width is None):
        raise ValueError("give either bins or width")
    v = F.col(col).cast("double")
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("total")).where(
        F.col("lo").isNotNull()
    )
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "total",
    )
    if bins is not None:
        shape = ends.select(
            "lo", "total", F.lit(bins).alias("k"), ((F.col("hi") - F.col("lo")) / bins).alias("w")
        )
    else:
        k = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo")) / width).cast("int"))
        shape = ends.select("lo", "total", k.alias("k"), F.lit(float(width)).alias("w"))
    s = shape.select(F.struct("lo", "k", "w").alias("v")).scalar()
    index = F.least(s["k"] - 1, F.floor((v - s["lo"]) / s["w"]).cast("int"))
    counts = (
        df.where(v.isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    )
    out = (
        shape.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .join(counts, "bin", "left")
        .withColumn("n", F.coalesce(F.col("_n"), F.lit(0)))
        .withColumn("bin_start", F.col("lo") + F.col("bin") * F.col("w"))
        .withColumn("bin_end", F.col("lo") + (F.col("bin") + 1) * F.col("w"))
    )
    picked = ["bin", "bin_start", "bin_end", "n"]
    if density:
        out = out.withColumn("density", F.col("n") / (F.col("total") * F.col("w")))
        picked.append("density")
    return out.select(*picked)


def histograms(df: DataFrame, cols: Sequence[str], bins: int) -> DataFrame:
    """Counts of ``bins`` even bins per column, in two scans for all columns together."""
    values = [F.col(c).cast("double") for c in cols]
    found = df.agg(
        *[F.min(v).alias(f"lo_{i}") for i, v in enumerate(values)],
        *[F.max(v).alias(f"hi_{i}") for i, v in enumerate(values)],
    )
    flat = [F.col(f"lo_{i}") == F.col(f"hi_{i}") for i in range(len(cols))]
    shapes = found.select(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.when(flat[i], F.col(f"lo_{i}") - 0.5).otherwise(F.col(f"lo_{i}")).alias("lo"),
                    F.when(flat[i], F.lit(1.0)).otherwise(F.col(f"hi_{i}") - F.col(f"lo_{i}")).alias("range"),
                )
                for i, c in enumerate(cols)
            ]
        ).alias("v")
    )
    s = shapes.scalar()
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.least(
                F.lit(bins - 1), F.floor((v - s[i]["lo"]) / (s[i]["range"] / bins)).cast("int")
            ).alias("bin"),
            v.isNotNull().alias("known"),
        )
        for i, (c, v) in enumerate(zip(cols, values, strict=True))
    ]
    counts = (
        df.select(F.inline(F.array(*entries)))
        .where("known")
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    width = F.col("range") / bins
    return (
        df.sparkSession.range(0, 1, 1, 1)
        .select(F.inline(s))
        .where(F.col("lo").isNotNull())
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        .join(counts, ["column_name", "bin"], "left")
        .select(
            "column_name",
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce(F.col("_n"), F.lit(0)).alias("n"),
        )
    )


def kde(
    df: DataFrame, col: str, points: int = 64, bandwidth: float | None = None, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density on an even grid reaching ``cut`` bandwidths past the data.

    The default bandwidth is the sample deviation times n^(-1/5). Every grid point is
    one sum of the same aggregation, added up in each task before one row per task is
    shuffled: rows are neither multiplied by the grid nor moved.
    """
    v = F.col(col).cast("double")
    values = df.where(v.isNotNull()).select(v.alias("_v"))
    raw = df.agg(
        F.count(v).alias("n"), F.stddev_samp(v).alias("s"), F.min(v).alias("lo"), F.max(v).alias("hi")
    )
    h = F.lit(float(bandwidth)) if bandwidth is not None else F.col("s") * F.pow("n", F.lit(-0.2))
    grid = (
        raw.withColumn("h", h)
        .withColumn("x0", F.col("lo") - cut * F.col("h"))
        .withColumn("dx", (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (points - 1))
        .select(F.struct("n", "h", "x0", "dx").alias("v"))
        .scalar()
    )
    at = [F.col("_g.x0") + F.col("_g.dx") * j for j in range(points)]
    z = [F.try_divide(x - F.col("_v"), F.col("_g.h")) for x in at]
    one = values.withColumn("_g", grid).agg(
        *[F.sum(F.exp(zj * zj * -0.5)).alias(f"_{j}") for j, zj in enumerate(z)]
    ).withColumn("_g", grid)
    scale = F.col("_g.n") * F.col("_g.h") * math.sqrt(2 * math.pi)
    return one.select("_g", F.posexplode(F.array(*[f"_{j}" for j in range(points)])).alias("i", "_s")).select(
        "i",
        (F.col("_g.x0") + F.col("_g.dx") * F.col("i")).alias("x"),
        F.try_divide(F.col("_s"), scale).alias("density"),
    )


def box_stats(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Quartiles, whisker ends within 1.5 interquartile ranges, and outlier count per group."""
    rows = df.select(*keys, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], keys, ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - iqr * 1.5, F.col("q3") + iqr * 1.5
    inside = (F.col("_v") >= low) & (F.col("_v") <= high)
    # The few quartile rows join the raw rows, which are then added up in each task.
    return (
        rows.join(q, list(keys))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def mutual_information(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 10
) -> DataFrame:
    """Plug-in mutual information (nats) of each feature with a numeric target.

    Numbers are cut into even bins, texts are their own classes. With joint counts
    n_xy the score is (sum n_xy ln n_xy - sum n_x ln n_x - sum n_y ln n_y) / n + ln n,
    three groupings of the joint table and no join.
    """
    numeric = [c for c in [*features, target] if not isinstance(df.schema[c].dataType, StringType)]
    ends = totals(
        df,
        **{f"lo_{c}": F.min(c).cast("double") for c in numeric},
        **{f"hi_{c}": F.max(c).cast("double") for c in numeric},
    )

    def bin_of(c: str) -> Column:
        if c not in numeric:
            return F.col(c)
        at = F.try_divide((F.col(c) - ends[f"lo_{c}"]) * bins, ends[f"hi_{c}"] - ends[f"lo_{c}"])
        return F.when(F.col(c).isNotNull(), F.least(F.lit(bins - 1), F.coalesce(F.floor(at), F.lit(0)))).cast("string")

    long = df.select(
        bin_of(target).alias("_y"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("_x")) for c in features])),
    ).where(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    joint = long.groupBy("feature", "_x", "_y").agg(F.count(F.lit(1)).alias("_n"))

    def terms(counts: DataFrame, sign: int, rows: Column) -> DataFrame:
        return counts.select(
            "feature", (F.col("_n") * F.log(F.col("_n")) * sign).alias("_t"), rows.alias("_rows")
        )

    per_x = joint.groupBy("feature", "_x").agg(F.sum("_n").alias("_n"))
    per_y = joint.groupBy("feature", "_y").agg(F.sum("_n").alias("_n"))
    none = F.lit(0).cast("bigint")
    return (
        terms(joint, 1, F.col("_n"))
        .unionByName(terms(per_x, -1, none))
        .unionByName(terms(per_y, -1, none))
        .groupBy("feature")
        .agg(F.sum("_t").alias("_t"), F.sum("_rows").alias("_rows"))
        .select(
            "feature",
            F.greatest(F.lit(0.0), F.col("_t") / F.col("_rows") + F.log("_rows")).alias("mi_score"),
        )
        .orderBy(F.desc("mi_score"), "feature")
    )


def series_sanity(df: DataFrame, key: str, value: str) -> DataFrame:
    """Activity, level and volatility of each family of series, with flags."""
    v = F.col(value).cast("double")
    active = F.when(v > 0, v)
    stats = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            (F.count(active) / F.count(F.lit(1))).alias("activity_ratio"),
            F.avg(active).alias("mean_sales_active"),
            F.stddev_samp(active).alias("std_sales_active"),
        )
        .withColumn(
            "cv_active",
            F.when(
                F.col("mean_sales_active") > 0, F.col("std_sales_active") / F.col("mean_sales_active")
            ).otherwise(
                F.lit(0.0)
            ),
        )
    )
    level = totals(stats, m=F.avg("mean_sales_active"), s=F.stddev_samp("mean_sales_active"))
    no = F.lit(False)
    return stats.select(
        "*",
        (F.col("activity_ratio") < 0.1).alias("flag_sparsity"),
        F.coalesce(F.col("mean_sales_active") > level["m"] + level["s"], no).alias("flag_high_sales"),
        F.coalesce(F.col("cv_active") > 1.0, no).alias("flag_high_volatility"),
    )


def _durbin_levinson(gamma: Column, nlags: int) -> Column:
    """Partial autocorrelations from the array of autocovariances of lags 0..``nlags``."""
    none = F.array().cast("array<double>")

    def step(state: Column, k: Column) -> Column:
        # What the shorter predictor explains of lag k.
        reach = F.aggregate(
            F.zip_with(state["phi"], F.reverse(F.slice(gamma, 2, k - 1)), lambda p, g: p * g),
            F.lit(0.0),
            lambda a, x: a + x,
        )
        new = F.when(state["var"] != 0, (F.get(gamma, k) - reach) / state["var"]).otherwise(float("nan"))
        return let(
            new,
            lambda a: F.struct(
                F.concat(
                    F.zip_with(state["phi"], F.reverse(state["phi"]), lambda p, q: p - a * q), F.array(a)
                ).alias("phi"),
                (state["var"] * (1 - a * a)).alias("var"),
                F.concat(state["out"], F.array(a)).alias("out"),
            ),
        )

    start = F.struct(
        none.alias("phi"), F.get(gamma, F.lit(0)).alias("var"), F.array(F.lit(1.0)).alias("out")
    )
    found = F.aggregate(F.sequence(F.lit(1), F.lit(nlags)), start, step, lambda s: s["out"])
    return F.when(F.get(gamma, F.lit(0)) > 0, found).otherwise(
        F.array_repeat(F.lit(float("nan")), nlags + 1)
    )


def pacf(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, nlags: int = 12
) -> DataFrame:
    """Partial autocorrelation of each series for lags 0..``nlags``, long form.

    The series' mean is taken off first, so a high level costs no digits. Autocovariances
    (divided by n) are sums over lagged products; the recursion then runs on the
    ``nlags + 1`` numbers of each series. Rows with a null key or value are dropped.
    """
    known = df.dropna(subset=[*keys, col])
    means = known.groupBy(*keys).agg(F.avg(F.col(col).cast("double")).alias("_mean"))
    centred = known.join(means, list(keys)).withColumn("_x", F.col(col).cast("double") - F.col("_mean"))
    lagged = series_window(
        centred, keys, order, {f"_l{k}": lag_of("_x", k) for k in range(1, nlags + 1)}, nlags
    )
    x = F.col("_x")
    gammas = [F.avg(x * x)] + [
        F.coalesce(F.sum(x * F.col(f"_l{k}")), F.lit(0.0)) / F.count(x) for k in range(1, nlags + 1)
    ]
    sums = lagged.groupBy(*keys).agg(F.array(*gammas).alias("_gamma"))
    found = let(F.col("_gamma"), lambda g: _durbin_levinson(g, nlags))
    return sums.select(*keys, F.posexplode(found).alias("lag", "pacf"))


def forecast_errors(
    df: DataFrame, actual: str, forecasts: Mapping[str, str], series: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute and symmetric percentage error per series, averaged over the series.

    ``forecasts`` maps an output prefix to a forecast column; one pass serves all.
    """
    y = F.col(actual)
    aggs, means = [], []
    for name, col in forecasts.items():
        p = F.col(col)
        gap = F.abs(y - p)
        aggs += [
            F.avg(gap).alias(f"{name}_mae"),
            (F.avg(gap * 2 / (F.abs(y) + F.abs(p) + F.lit(1e-8))) * 100).alias(f"{name}_smape"),
        ]
        means += [F.avg(f"{name}_mae").alias(f"{name}_mae"), F.avg(f"{name}_smape").alias(f"{name}_smape")]
    per_series = df.groupBy(*by, *[s for s in series if s not in by]).agg(*aggs)
    return per_series.groupBy(*by).agg(*means) if by else per_series.agg(*means)


def family_metrics(
    df: DataFrame, keys: Sequence[str], actual: str, base: str, final: str, correction: str
) -> DataFrame:
    """Compare a base forecast with the corrected one, per family, in one aggregation.

    ``mae_improvement_pct`` is the error removed by the correction,
    ``xgb_contrib_ratio`` its size against the base forecast, ``explained_frac`` the
    share of the base residual's variance it removes.
    """
    y, b, f, c = (F.col(x) for x in (actual, base, final, correction))
    residual = y - b
    return (
        df.groupBy(*keys)
        .agg(
            F.avg(F.abs(y - b)).alias("lr_mae"),
            F.avg(F.abs(y - f)).alias("hybrid_mae"),
            (F.avg(F.abs(c)) / (F.avg(F.abs(b)) + F.lit(1e-8))).alias("xgb_contrib_ratio"),
            (1 - F.try_divide(F.var_pop(residual - c), F.var_pop(residual))).alias("explained_frac"),
        )
        .withColumn(
            "mae_improvement_pct",
            F.try_divide(F.col("lr_mae") - F.col("hybrid_mae"), F.col("lr_mae")) * 100,
        )
    )


def choose_policy(
    metrics: DataFrame, min_explained_frac: float = 0.05, min_mae_improvement_pct: float = 5.0
) -> DataFrame:
    """Keep the correction only where it explains and improves enough."""
    weak = (F.col("explained_frac") < min_explained_frac) | (
        F.col("mae_improvement_pct") < min_mae_improvement_pct
    )
    return metrics.withColumn("policy", F.when(weak, F.lit("lr")).otherwise(F.lit("hybrid")))
