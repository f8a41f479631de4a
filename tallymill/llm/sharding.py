"""Shards of near-equal bytes by sampled splitters.

A record's place in the order is its key's hash, then its own. A size-weighted sample of
the places gives splitters that cut the order into many ranges of about equal bytes; all
rows are put into ranges, the bytes of every range are counted exactly, and the shards'
boundaries fall where the running total passes each shard's share. A range that holds a
boundary is thereby subdivided record by record, and a key whose records overfill a range
is spread over several ranges by the second half of the place.

Records of one key stay in one shard unless they hold more than a shard's share. Keys of more
than a fiftieth of it, at most fifty times as many as shards, are dealt whole before the
others, the largest first, each to the emptiest shard; the boundaries of the others then fill
every shard up to the same level.

Null group hashes and sizes count as zero. Rows that repeat are counted once with their number
and spread again at the end, so no number of copies overfills a task. Equal places go by id,
then size. An empty table has no rows; only the named columns are carried along, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.llm.registry import query, table
from tallymill.session import stored


def weighted_splitters(rows: DataFrame, ranges: int, per_range: int, total: int) -> np.ndarray:
    """Quantile boundaries of ``place`` by bytes, from a size-weighted hash sample.

    A row is drawn with probability in proportion to its bytes, and one that is larger
    than the sampling step counts as often as it holds the step. The expected size of the
    sample is ``ranges * per_range``, whatever the table's size. The draw hangs on the
    row's own values, so a rerun draws the same rows.
    """
    step = max(1.0, total / (ranges * per_range))
    share = F.col("size") * F.col("copies") / F.lit(step)
    draw = F.pmod(F.xxhash64("place", "size", F.lit("draw")), F.lit(2**40)) / F.lit(float(2**40))
    drawn = (
        rows.withColumn("weight", F.floor(share + draw))
        .filter("weight > 0")
        .select("place", "weight")
        .toPandas()
        .sort_values("place")
    )
    if drawn.empty:
        return np.zeros(0, np.int64)
    reached = drawn["weight"].cumsum().to_numpy()
    wanted = np.arange(1, ranges) * reached[-1] / ranges
    splitters = np.unique(drawn["place"].to_numpy()[np.searchsorted(reached, wanted)])
    # A boundary inside a key moves in front of it; a key that holds several boundaries
    # overfills a range and keeps the others.
    keys = splitters >> 32
    first = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    return np.where(first, (keys << 32) - 1, splitters)


class WholeGroups:
    """Large groups dealt whole to shards, and what that leaves of every shard."""

    def __init__(self, groups: np.ndarray, sizes: np.ndarray, counts: np.ndarray, shards: int, total: int):
        order = np.argsort(groups)
        self.groups, sizes, counts = groups[order], sizes[order], counts[order]
        self.shard = np.zeros(len(order), np.int32)
        # Rows of the groups dealt to the same shard before.
        self.offset = np.zeros(len(order), np.int64)
        load, held = np.zeros(shards), np.zeros(shards, np.int64)
        for i in np.lexsort((self.groups, -sizes)):
            at = int(np.argmin(load))
            self.shard[i], self.offset[i] = at, held[at]
            load[at] += sizes[i]
            held[at] += counts[i]
        self.bytes_before = np.append(0, np.cumsum(sizes)).astype(np.int64)
        self.rows_before = np.append(0, np.cumsum(counts)).astype(np.int64)
        # The level to which the other records fill the shards.
        left, level = total - float(sizes.sum()), 0.0
        for n, top in enumerate(np.sort(load), 1):
            level = (left + np.sort(load)[:n].sum()) / n
            if n == shards or level <= np.sort(load)[n]:
                break
        self.edges = np.cumsum(np.maximum(0, level - load))

    def place(self, group: np.ndarray) -> dict[str, np.ndarray]:
        """Of every row's group: dealt whole or not, where to, and what of whole groups is before it."""
        at = np.searchsorted(self.groups, group)
        safe = np.minimum(at, max(0, len(self.groups) - 1))
        whole = (self.groups[safe] == group) if len(self.groups) else np.zeros(len(group), bool)
        pick = lambda values: np.where(whole, values[safe], 0) if len(self.groups) else np.zeros(len(group), np.int64)
        return {
            "whole": whole,
            "target": pick(self.shard).astype(np.int32),
            "offset": pick(self.offset).astype(np.int64),
            "skip_bytes": self.bytes_before[at],
            "skip_rows": self.rows_before[at],
        }


def shard_by_bytes(
    rows: DataFrame,
    key: str,
    key_hash: str,
    size: str,
    shards: int,
    ranges_per_shard: int = 32,
    samples_per_range: int = 32,
) -> DataFrame:
    """``rows`` with ``shard`` and a gapless ``slot`` in it.

    ``key`` is the record's id, ``key_hash`` a number in [0, 2^32) that records of one
    group share, ``size`` its bytes. Only these three columns are carried along.
    """
    spark = rows.sparkSession
    half = F.lit(2**32)
    place = (F.col("group") - F.lit(2**31)) * half + F.pmod(F.xxhash64("id"), half)
    records = stored(
        rows.select(
            F.col(key).alias("id"),
            F.coalesce(F.col(key_hash).cast("long"), F.lit(0)).alias("group"),
            F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"),
        )
        .groupBy("id", "group", "size")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("place", place),
        "records",
    )
    whole = records.agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.count(F.lit(1)).alias("rows")
    ).first()
    total = whole["bytes"] or 0
    # About equal ranges of at most some 200,000 records each, at every size.
    ranges = max(shards * ranges_per_shard, (whole["rows"] or 0) // 200_000)
    splitters = weighted_splitters(records, ranges, samples_per_range, total)

    weight = F.col("size") * F.col("copies")
    share = total / shards if total else 1.0
    large = records.groupBy("group").agg(F.sum(weight).alias("bytes"), F.sum("copies").alias("count"))
    # At most fifty for each shard.
    found = large.filter((F.col("bytes") > share / 50) & (F.col("bytes") <= share)).toPandas()
    dealt_whole = WholeGroups(*(found[c].to_numpy(np.int64) for c in ("group", "bytes", "count")), shards, total)

    def into_range(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["range"] = np.searchsorted(splitters, batch["place"].to_numpy(), side="left")
            yield batch.assign(**dealt_whole.place(batch["group"].to_numpy()))

    kind = records.schema["id"].dataType.simpleString()
    ranged = records.mapInPandas(
        into_range,
        f"id {kind}, group long, size long, copies long, place long, range int, "
        "whole boolean, target int, offset long, skip_bytes long, skip_rows long",
    )
    sums = ranged.groupBy("range").agg(F.sum(weight).alias("bytes"), F.sum("copies").alias("count"))
    # One row per range: their number is a parameter or a small fraction of the rows.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("rows_before"),
    )
    running = (
        Window.partitionBy("range")
        .orderBy("place", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    group = Window.partitionBy("range", "group")
    placed = stored(
        ranged.join(offsets, "range")
        .withColumn("before", F.col("bytes_before") + F.coalesce(F.sum(weight).over(running), F.lit(0)))
        .withColumn("index", F.col("rows_before") + F.coalesce(F.sum("copies").over(running), F.lit(0)))
        .withColumn("group_bytes", F.sum(weight).over(group))
        .withColumn("group_before", F.min("before").over(group))
        .drop("place", "range", "bytes_before", "rows_before"),
        "placed",
    )
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    each = each.withColumn("index", F.col("index") + F.col("copy"))
    point = F.when(
        F.col("group_bytes") <= F.lit(share / 50), F.col("group_before") + F.col("group_bytes") / 2
    ).otherwise(F.col("before") + (F.col("copy") + 0.5) * F.col("size"))
    edges = F.array(*[F.lit(float(e)) for e in dealt_whole.edges])
    passed = F.size(F.filter(edges, lambda e: e <= point - F.col("skip_bytes")))
    others = each.filter(~F.col("whole")).withColumn("shard", F.least(passed, F.lit(shards - 1)))
    others = others.withColumn("index", F.col("index") - F.col("skip_rows"))
    # Shards follow the order, so a slot is the distance from the shard's first row; whole
    # groups follow in the order in which they were dealt.
    firsts = stored(
        others.groupBy("shard").agg(F.min("index").alias("first"), F.count(F.lit(1)).alias("filled")), "shard-firsts"
    )
    laid = others.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("index") - F.col("first"))
    groups = each.filter("whole")
    starts = F.broadcast(groups.groupBy("group").agg(F.min("index").alias("start")))
    after = F.coalesce(F.col("filled"), F.lit(0)) + F.col("offset") + F.col("index") - F.col("start")
    together = (
        groups.withColumn("shard", F.col("target"))
        .join(starts, "group")
        .join(F.broadcast(firsts), "shard", "left")
        .withColumn("slot", after)
    )
    columns = [
        F.col("id").alias(key), "size", F.col("group").alias(key_hash), "shard", F.col("slot").cast("long").alias("slot")
    ]
    return laid.select(*columns).unionByName(together.select(*columns))


def write_shards(df: DataFrame, path: str) -> None:
    """Write records that carry a ``shard``, one folder per shard."""
    df.write.partitionBy("shard").parquet(path)


@query("op3_sampled_splitters")
def op3_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes; copies of a text stay together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    records = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")
    )
    dealt = shard_by_bytes(records, "doc_id", "text_crc32", "size", 24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
