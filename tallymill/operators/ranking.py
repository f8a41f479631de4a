"""Whole-table ranks, quantile scores, both ends of an order, custom label order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.operators.quantiles import exact_quantiles
from tallymill.session import stored

_SAMPLE = 255
_STEP = 16


def head_tail(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first ``k`` and the last ``k`` rows along ``order`` (which breaks all ties)."""
    first = df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(k)
    last = df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(k)
    return first.withColumn("end", F.lit("head")).unionByName(last.withColumn("end", F.lit("tail")))


def label_rank(col: str, labels: Sequence[str]) -> Column:
    """Position of the value in ``labels``; null when absent."""
    pairs = [F.lit(x) for i, label in enumerate(labels) for x in (label, i)]
    return F.try_element_at(F.create_map(*pairs), F.col(col))


def order_by_labels(df: DataFrame, col: str, labels: Sequence[str], *then: str) -> DataFrame:
    """Sort by a given order of labels; unknown labels last."""
    return df.orderBy(label_rank(col, labels).asc_nulls_last(), *then)


def _located(df: DataFrame, edges: Column, coarse: Column) -> DataFrame:
    """``df`` with ``_sub``, the number of ``edges`` up to the row's ``_key``.

    Every sixteenth edge is looked at first, then the fifteen between two of them.
    """
    fine = F.filter(F.slice(edges, F.col("_c") * _STEP + 1, F.lit(_STEP - 1)), lambda e: e <= F.col("_key"))
    return (
        df.withColumn("_c", F.size(F.filter(coarse, lambda e: e <= F.col("_key"))))
        .withColumn("_sub", F.col("_c") * _STEP + F.size(fine))
        .drop("_c")
    )


def _edges(picked: DataFrame, *keys: str) -> DataFrame:
    """Sorted edges, and every sixteenth of them, from rows of ``_key``."""
    edges = picked.groupBy(*keys).agg(F.array_sort(F.collect_list("_key")).alias("_edges"))
    return edges.withColumn("_coarse", F.expr(f"filter(_edges, (e, i) -> (i + 1) % {_STEP} = 0)"))


def ordered_blocks(df: DataFrame, order: Sequence[str], rows: int = 1_000_000) -> DataFrame:
    """``df`` written with ``_key`` and ``_block``, a number that never decreases along ``order``.

    255 rows picked by the hash of their order key (the same on every run) cut the order
    into 256 blocks. Blocks of more than ``rows`` rows are cut again in the same way, all in
    the same jobs, until none is left; so the number of blocks follows the table, and a value
    shared by a third of it is cut by the next order column. ``order`` must be unique.
    """
    keyed = df.withColumn("_key", F.struct(*order))
    picked = keyed.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(_SAMPLE)
    edges = _edges(picked).select(F.struct("_edges", "_coarse").alias("v")).scalar()
    placed = _located(keyed.withColumn("_v", edges), F.col("_v._edges"), F.col("_v._coarse")).drop("_v")
    placed = stored(placed.withColumnRenamed("_sub", "_block").withColumn("_block", F.col("_block").cast("long")), "blocks")
    while True:
        large = stored(
            placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select("_block"),
            "large-blocks",
        )
        if large.isEmpty():
            return placed
        inside = placed.join(large, "_block", "left_semi").select("_block", "_key")
        first = Window.partitionBy("_block").orderBy(F.xxhash64("_key"), "_key")
        picked = inside.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= _SAMPLE)
        finer = stored(_edges(picked, "_block"), "block-edges")
        placed = _located(placed.join(finer, "_block", "left"), F.col("_edges"), F.col("_coarse"))
        sub = F.when(F.col("_edges").isNull(), F.lit(0)).otherwise(F.col("_sub"))
        placed = stored(
            placed.withColumn("_block", F.col("_block") * (_SAMPLE + 1) + sub).drop("_edges", "_coarse", "_sub"), "blocks"
        )


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank", rows: int = 1_000_000) -> DataFrame:
    """Row number 1..n over the whole table along ``order``, without a one-task window.

    ``order`` must be unique per row. Rows are numbered within their block of
    :func:`ordered_blocks`, none of more than ``rows`` rows, and shifted by the counts of
    the blocks before it, which are added up in groups of 4,096 first.
    """
    located = ordered_blocks(df, order, rows)
    counts = located.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    # Blocks are numbered with gaps after a second cut; their groups follow the order too.
    counts = counts.withColumn("_block_group", F.floor(F.col("_block") / 4096))
    earlier = Window.partitionBy("_block_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_block_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        counts.groupBy("_block_group")
        .agg(F.sum("_n").alias("_all"))
        .select("_block_group", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_base"))
    )
    offsets = (
        counts.withColumn("_in", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .join(groups, "_block_group")
        .select("_block", (F.col("_in") + F.col("_base")).alias("_offset"))
    )
    inside = Window.partitionBy("_block").orderBy("_key")
    return (
        located.withColumn("_row", F.row_number().over(inside))
        .join(offsets, "_block", "left")
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .select(*df.columns, name)
    )


def quantile_score(
    df: DataFrame, col: str, labels: Sequence, name: str, tie: str | None = None
) -> DataFrame:
    """Label of the equal-frequency bin of ``col``, bins right-closed.

    Without ``tie`` the edges are the exact quantiles of the values; repeated edges
    raise when the query runs. With ``tie`` the rows are first ranked by (col, tie),
    so bins hold equal numbers of rows whatever the ties.
    """
    n = len(labels)
    if tie is not None:
        rows = df.agg(F.count(F.lit(1))).scalar()
        ranked = global_rank(df, [col, tie], "_rank")
        # Smallest k with rank <= 1 + (rows - 1) * k / n.
        bin_of = F.greatest(
            F.lit(1), F.ceil(F.try_divide((F.col("_rank") - 1) * n, rows - 1))
        ).cast("int")
        picked = F.element_at(F.array(*map(F.lit, labels)), F.coalesce(bin_of, F.lit(1)))
        return ranked.withColumn(name, picked).drop("_rank")
    probs = [k / n for k in range(n + 1)]
    cols = [f"e{k}" for k in range(n + 1)]
    edges = exact_quantiles(df, col, probs, names=cols).select(F.struct(*cols).alias("v")).scalar()
    scored = df.withColumn("_e", edges)
    repeated = reduce(
        lambda a, b: a | b, [F.col(f"_e.e{k}") == F.col(f"_e.e{k + 1}") for k in range(n)]
    )
    pick = F.when(repeated, F.raise_error(F.lit("quantile edges repeat; give a tie column")))
    for k, label in enumerate(labels[:-1], start=1):
        pick = pick.when(F.col(col) <= F.col(f"_e.e{k}"), F.lit(label))
    pick = pick.when(F.col(col).isNotNull(), F.lit(labels[-1]))
    return scored.withColumn(name, pick).drop("_e")
