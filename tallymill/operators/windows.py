"""Per-group and per-series row operators.

A plain window keeps a whole series in one task. Here a long series is cut into pieces of
consecutive rows, and only the rows next to a cut, whose frame reaches into another piece,
are exchanged; so results are exact and a series holding a third of the table is spread
over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallymill.functions.columns import pearson
from tallymill.operators.cuts import long_groups, same_keys, with_blocks
from tallymill.session import stored


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of every group; ``order`` must break all ties.

    Spark drops rows beyond rank ``n`` before the shuffle (window group limit), so
    at most ``n`` rows per group leave each task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def group_stat_feature(
    df: DataFrame, key: str, value: str, fn: Callable[[str], Column], name: str
) -> DataFrame:
    """Attach ``fn(value)`` of the row's group to each row; null for a null key.

    Aggregate-then-join: the aggregate combines before its shuffle and a skewed
    stream side can be split, where a window would pull the group into one task.
    """
    stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(fn(value).alias(name))
    return df.join(stats, key, "left").select(*df.columns, name)


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    blocks: Sequence[Column],
    name: str = "_pos",
) -> DataFrame:
    """Number the rows of each series from 0 along ``order`` (nulls last).

    ``blocks`` must never decrease along ``order``. Rows are numbered inside
    (series, block); the offset of a block is the running total of the block counts,
    a table of one row per series and block. Rows with a null key are dropped.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    # A struct is never null itself, so rows of a null block find their offset too; the
    # flags put those blocks last.
    block = F.struct(*[part for b in blocks for part in (b.isNull(), b)])
    tagged = df.withColumn("_block", block)
    before = (
        Window.partitionBy(*keys)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        tagged.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(
        *[F.col(c).asc_nulls_last() for c in order]
    )
    return (
        tagged.withColumn("_row", F.row_number().over(inside) - 1)
        .join(offsets, [*keys, "_block"])
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .select(*df.columns, name)
    )


def series_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    exprs: Mapping[str, Callable[[WindowSpec], Column]],
    before: int,
    after: int = 0,
    chunk: int = 10_000,
) -> DataFrame:
    """Add ``exprs[name](window)`` columns, reaching ``before`` / ``after`` rows.

    ``order`` must break all ties within a series; rows with a null key are dropped.
    Rows are shuffled once, to the pieces of their series. A series of at most ``chunk``
    rows is one piece. In a longer one only the rows next to a cut are exchanged: their
    frame reaches into another piece, so it is worked out again around the cut.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    cuts = long_groups(df, keys, order[0], max(chunk, before + after + 1))
    placed = with_blocks(df, keys, order[0], cuts)
    sorted_by = [F.col(c).asc_nulls_last() for c in order]
    w = Window.partitionBy(*keys, "_block").orderBy(*sorted_by)
    inner = placed.withColumns({n: e(w) for n, e in exprs.items()})
    if cuts is None:
        return inner.select(*df.columns, *exprs)

    # Where each piece begins, counted in rows; one array per long series.
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    sizes = placed.join(cuts.select(*[f"_k_{k}" for k in keys]), same_keys(keys, "_k_"), "left_semi").groupBy(
        *named, "_block"
    ).agg(F.count(F.lit(1)).alias("_n"))
    ends = sizes.groupBy(*[f"_k_{k}" for k in keys]).agg(
        F.array_sort(F.collect_list(F.struct("_block", "_n"))).alias("_s")
    )
    starts = F.transform(
        "_s",
        lambda s: F.struct(
            s["_block"].alias("block"),
            F.aggregate(
                F.filter("_s", lambda x: x["_block"] < s["_block"]), F.lit(0).cast("long"), lambda a, x: a + x["_n"]
            ).alias("start"),
        ),
    )
    starts = stored(ends.select(*[f"_k_{k}" for k in keys], starts.alias("_starts")), "piece-starts")
    at = F.element_at(F.filter("_starts", lambda s: s["block"] == F.col("_block")), 1)["start"]
    row = inner.withColumn("_row", F.row_number().over(w)).join(starts, same_keys(keys, "_k_"), "left")
    row = row.withColumn("_pos", F.coalesce(at, F.lit(0)) + F.col("_row") - 1)
    inside = F.filter("_starts", lambda s: s["start"] > 0)
    borders = F.coalesce(F.transform(inside, lambda s: s["start"]), F.array().cast("array<bigint>"))

    def reaches(back: int, ahead: int) -> Column:
        """The borders for which the row lies within so many rows after, or before, them."""
        return F.filter(
            borders, lambda b: (F.col("_pos") - back < b) & (b <= F.col("_pos") + ahead)
        )

    whole = row.where(F.size(reaches(before, after)) == 0).select(*df.columns, *exprs)
    # Every row next to a border is worked out at the first one in its reach; what its
    # frame needs lies within twice that distance.
    near = before + after + 1
    mine = F.element_at(reaches(before, after), 1)
    edge = (
        row.drop(*exprs)
        .where(F.size(reaches(near, near)) > 0)
        .withColumn("_own", F.when(F.size(reaches(before, after)) > 0, mine))
        .withColumn("_block_edge", F.explode(reaches(near, near)))
    )
    around = Window.partitionBy(*keys, "_block_edge").orderBy(*sorted_by)
    again = (
        edge.withColumns({n: e(around) for n, e in exprs.items()})
        .where(F.col("_own") == F.col("_block_edge"))
        .select(*df.columns, *exprs)
    )
    return whole.unionByName(again)


def lag_of(col: str, k: int) -> Callable[[WindowSpec], Column]:
    return lambda w: F.lag(col, k).over(w)


def trailing_mean(col: str, width: int) -> Callable[[WindowSpec], Column]:
    """Mean of the ``width`` rows before this one; null unless all are present."""
    def build(w):
        frame = w.rowsBetween(-width, -1)
        return F.when(F.count(col).over(frame) == width, F.avg(col).over(frame))
    return build


def add_lags(df, keys, order, col, lags, **how) -> DataFrame:
    """``lag_k`` columns: the value ``k`` rows earlier in the series."""
    return series_window(df, keys, order, {f"lag_{k}": lag_of(col, k) for k in lags}, max(lags), **how)


def add_rolling_means(df, keys, order, col, widths, **how) -> DataFrame:
    """``roll_w`` columns: mean of the previous ``w`` rows, this one excluded."""
    return series_window(
        df, keys, order, {f"roll_{w}": trailing_mean(col, w) for w in widths}, max(widths), **how
    )


def centered_mean(
    df, keys, order, col, width: int, min_periods: int, name: str = "centered_mean", **how
) -> DataFrame:
    """Mean over ``width`` rows around this one, null below ``min_periods`` values.

    An even width reaches one row further back than forward.
    """
    back, ahead = width // 2, (width - 1) // 2

    def build(w):
        frame = w.rowsBetween(-back, ahead)
        return F.when(F.count(col).over(frame) >= min_periods, F.avg(col).over(frame))

    return series_window(df, keys, order, {name: build}, back, ahead, **how)


def time_index(
    df: DataFrame, date: str, by: Sequence[str] = (), name: str = "time_idx"
) -> DataFrame:
    """Position of each row's date among the distinct dates present (0 first).

    Only the distinct dates are numbered. A date column has at most 3.7 million
    distinct values over its whole range, which bounds the window of each ``by``
    group; without ``by`` the same bound makes the dates safe to broadcast.
    """
    day = F.col(date).cast("date")
    dates = df.where(day.isNotNull()).select(*by, day.alias("_day")).distinct()
    w = Window.partitionBy(*by).orderBy("_day")
    numbered = dates.withColumn(name, (F.row_number().over(w) - 1).cast("int"))
    if not by:
        numbered = F.broadcast(numbered)
    return (
        df.withColumn("_day", day)
        .join(numbered, [*by, "_day"], "left")
        .select(*df.columns, name)
    )


# Months in each calendar unit.
_UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def period_index(
    df: DataFrame, ts: str, unit: str, name: str = "period_id", calendar: bool = False
) -> DataFrame:
    """Position of the row's quarter, month, … among those present; gaps compress.

    With ``calendar`` an absent period still counts. The periods are at most the
    distinct dates (see :func:`time_index`), so they are broadcast.
    """
    start = F.trunc(F.col(ts), unit)
    began = F.col("_start").alias(f"{name}_start")
    placed = df.withColumn("_start", start)
    if calendar:
        month = F.year("_start") * 12 + F.month("_start")
        first = df.agg(F.min(start)).scalar()
        since = month - (F.year(first) * 12 + F.month(first))
        return placed.select(
            *df.columns, F.floor(since / _UNIT_MONTHS[unit]).cast("int").alias(name), began
        )
    periods = df.where(start.isNotNull()).select(start.alias("_start")).distinct()
    numbered = periods.withColumn(
        name, (F.row_number().over(Window.orderBy("_start")) - 1).cast("int")
    )
    return placed.join(F.broadcast(numbered), "_start", "left").select(*df.columns, name, began)


def autocorr(
    df: DataFrame,
    groups: Sequence[str],
    series: Sequence[str],
    date: str,
    col: str,
    flat: bool = False,
    name: str = "autocorr",
) -> DataFrame:
    """Lag-1 autocorrelation of ``col`` per group.

    By default it is taken per series and averaged over the group's series.
    ``flat=True`` lags once over the group ordered by (series, date), so the first
    row of a series is paired with the last row of the one before it.
    """
    for key in [*groups, *series]:
        df = df.where(F.col(key).isNotNull())
    out = series_window(df, [*groups, *series], [date], {"_prev": lag_of(col, 1)}, 1)
    if flat:
        # What crosses from one series to the next is one pair per series.
        at, nulls = F.col(date), F.col(date).isNull()
        ends = df.groupBy(*groups, *series).agg(
            F.min(F.struct(nulls, at, F.col(col).alias("v")))["v"].alias("_first"),
            F.max(F.struct(nulls, at, F.col(col).alias("v")))["v"].alias("_last"),
        )
        crossing = ends.withColumn("_prev", F.lag("_last").over(Window.partitionBy(*groups).orderBy(*series)))
        pairs = out.select(*groups, F.col(col), "_prev").unionByName(
            crossing.select(*groups, F.col("_first").alias(col), "_prev")
        )
        # Rows without a value before them count for nothing, so a first row counts once.
        return pairs.groupBy(*groups).agg(pearson(F.col(col), F.col("_prev")).alias(name))
    per_series = out.groupBy(*groups, *series).agg(
        pearson(F.col(col), F.col("_prev")).alias("_r")
    )
    return per_series.groupBy(*groups).agg(F.avg("_r").alias(name))
