"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import stored


def connect(links: DataFrame, name: str) -> DataFrame:
    """Components of ``links`` (a, b): every linked node with its component's least node.

    Alternates large and small stars until nothing changes. Each round is a minimum per
    node, combined before the shuffle, and a join; it is written, so lineage stays short.
    """

    def star(edges: DataFrame, keep, both: bool) -> DataFrame:
        around = edges.union(edges.select("b", "a")) if both else edges
        lowest = around.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m")
        )
        return around.join(lowest, around["a"] == lowest["u"]).filter(keep)

    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), name
    )
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    last = edges.agg(*sums).first()
    while last[0]:
        large = star(edges, F.col("b") > F.col("a"), True).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        small = star(large, F.lit(True), False)
        edges = stored(
            small.select("b", "m")
            .union(small.select("a", "m"))
            .toDF("a", "b")
            .filter("a > b")
            .distinct(),
            name,
        )
        now = edges.agg(*sums).first()
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
