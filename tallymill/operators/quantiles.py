"""Exact quantiles per group without collecting a group in one task.

The exact ``percentile`` aggregate keeps every distinct value of a group in one
buffer. Here a mergeable sketch proposes a narrow interval around each wanted rank,
exact counts say which interval really holds it, and only the values of those
intervals are counted and ordered. The counts decide, so the result is exact however
rough the sketch is; the sketch only sets how many values are left to order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    keys: Sequence[str] = (),
    names: Sequence[str] | None = None,
    accuracy: int = 10_000,
) -> DataFrame:
    """Linear-interpolated quantiles of ``col`` (nulls skipped), one row per group.

    Groups with a null key or no value have no row; without keys there is one row,
    null when the column is empty.
    """
    names = [f"q{i}" for i in range(len(probs))] if names is None else list(names)
    keys = list(keys)
    values = df.select(*keys, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    for key in keys:
        values = values.where(F.col(key).isNotNull())

    width = 2.0 / accuracy
    around = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-width, width)})
    sketch = F.percentile_approx("_v", [*around], accuracy).alias("_edges")
    if keys:
        cut = values.join(values.groupBy(*keys).agg(sketch), keys)
    else:
        cut = values.withColumn("_edges", values.agg(sketch).scalar())
    # Number of edges at or below the value. The edges are few and their number is known,
    # so this is a sum of comparisons in generated code.
    passed = [(F.col("_edges")[i] <= F.col("_v")).cast("int") for i in range(len(around))]
    cut = cut.withColumn("_part", reduce(lambda a, b: a + b, passed)).drop("_edges")

    # One row per group and interval.
    by_part = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy(*keys).orderBy("_part")
    whole = Window.partitionBy(*keys)
    starts = by_part.select(
        *keys,
        "_part",
        "_n",
        (F.sum("_n").over(up_to) - F.col("_n")).alias("_start"),
        F.sum("_n").over(whole).alias("_all"),
    )
    ranks = F.array(
        *[
            F.struct(F.lit(f"{end}{i}").alias("slot"), fn((F.col("_all") - 1) * F.lit(p)).alias("rank"))
            for i, p in enumerate(probs)
            for end, fn in (("lo", F.floor), ("hi", F.ceil))
        ]
    )

    def ranks_between(first, end):
        return F.filter(ranks, lambda r: (r["rank"] >= first) & (r["rank"] < end))

    wanted = starts.where(
        F.size(ranks_between(F.col("_start"), F.col("_start") + F.col("_n"))) > 0
    ).select(*keys, "_part", "_start", "_all")

    # Only the values of those intervals are counted one by one and ordered.
    on = [*keys, "_part"]
    counted = (
        cut.join(wanted, on)
        .groupBy(*on, "_v")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("_start").alias("_start"),
            F.max("_all").alias("_all"),
        )
    )
    inside = Window.partitionBy(*on).orderBy("_v")
    placed = counted.withColumn("_end", F.col("_start") + F.sum("_n").over(inside))
    hits = placed.select(
        *keys,
        "_v",
        "_all",
        F.explode(ranks_between(F.col("_end") - F.col("_n"), F.col("_end"))).alias("_hit"),
    )

    def at(slot):
        return F.max(F.when(F.col("_hit.slot") == slot, F.col("_v")))

    found = hits.groupBy(*keys).agg(
        F.max("_all").alias("_all"),
        *[at(f"{end}{i}").alias(f"_{end}{i}") for i in range(len(probs)) for end in ("lo", "hi")],
    )
    out = []
    for i, (p, name) in enumerate(zip(probs, names)):
        position = (F.col("_all") - 1) * F.lit(p)
        fraction = position - F.floor(position)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((low + (high - low) * fraction).alias(name))
    return found.select(*keys, *out)
