"""Exact links inside clusters of sets, block by block in tasks.

A cluster is a group of nodes among which links may lie; between clusters there are none.
Tasks compare whole sets and return only links that join parts not joined before, so a task
of ``n`` members returns fewer than ``n`` rows, however many of its pairs are near.

Small clusters are dealt to tasks by hash. A cluster beyond a block's bytes is cut into
blocks by hash, and a few members, its leaders, go to every block, so that a group of copies
is one part after the first step. What is then outside a cluster's largest part, and only
that, meets the members of all blocks in a second step. So all pairs of a cluster are covered.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.components import connect
from tallymill.session import stored

_BLOCK_BYTES = 4_000_000
_LEADERS = 4
# Fewer targets than this are intersected one by one instead of scanning lists.
_FEW = 12


def reaches(common, left, right, percent: int):
    """Whether ``100 * common >= percent * union`` for sets of the given sizes."""
    return 100 * common >= percent * (left + right - common)


class Parts:
    """Disjoint parts of ``range(size)`` that grow together."""

    def __init__(self, first: np.ndarray):
        self.of = first.copy()

    def join(self, a: int, b: int) -> bool:
        if self.of[a] == self.of[b]:
            return False
        self.of[self.of == self.of[b]] = self.of[a]
        return True


class Lists:
    """Inverted lists of the elements that several of the sets hold."""

    def __init__(self, sets: list[np.ndarray]):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        elements = np.concatenate(sets)
        order = np.argsort(elements, kind="stable")
        elements, owner = elements[order], owner[order]
        starts = np.flatnonzero(np.append(True, elements[1:] != elements[:-1]))
        sizes = np.diff(np.append(starts, len(elements)))
        number = np.repeat(np.arange(len(starts)), sizes)
        shared = sizes[number] > 1
        self.owner, self.starts, self.sizes = owner, starts, sizes
        back = np.argsort(owner[shared], kind="stable")
        self.numbers = number[shared][back]
        self.bounds = np.searchsorted(owner[shared][back], np.arange(len(sets) + 1))
        self.count = len(sets)

    def common(self, i: int) -> np.ndarray:
        """How many elements each set has in common with set ``i``."""
        own = self.numbers[self.bounds[i] : self.bounds[i + 1]]
        sizes = self.sizes[own]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[own] - (ends - sizes), sizes)
        return np.bincount(self.owner[at], minlength=self.count)


def links(
    sets: list[np.ndarray],
    percent: int,
    parts: np.ndarray | None = None,
    asking: np.ndarray | None = None,
    likely: Callable | None = None,
) -> list[tuple[int, int]]:
    """Pairs that reach ``percent`` and join what ``parts`` (then earlier pairs) left apart.

    ``asking`` marks the sets of which one must be in a pair. ``likely(i, others)`` may
    drop others before sets are compared.
    """
    count = len(sets)
    size = np.array([len(s) for s in sets])
    joined, lists, found = Parts(np.arange(count) if parts is None else parts), None, []
    order = np.argsort(size, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    for i in order.tolist():
        if asking is not None and not asking[i]:
            continue
        apart = joined.of != joined.of[i]
        # Every pair is looked at once: from its earlier set, or from the only asking one.
        apart &= (place > place[i]) if asking is None else (place > place[i]) | ~asking
        fits = (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])) & apart
        others = np.flatnonzero(fits)
        if len(others) and likely is not None:
            others = likely(i, others)
        if not len(others):
            continue
        if len(others) < _FEW or count < _FEW:
            own = sets[i]
            at = [np.searchsorted(own, sets[j]) for j in others]
            common = np.array(
                [(own[np.minimum(a, len(own) - 1)] == sets[j]).sum() for a, j in zip(at, others, strict=True)]
            )
        else:
            lists = lists or Lists(sets)
            common = lists.common(i)[others]
        for j in others[reaches(common, size[i], size[others], percent)].tolist():
            if joined.join(i, j):
                found.append((i, j))
    return found


def link_clusters(
    members: DataFrame,
    decode: Callable,
    percent: int,
    prepare: Callable | None = None,
    name: str = "cluster",
) -> DataFrame:
    """Links (a, b) that join the nodes of each cluster into their components.

    ``members`` has cluster, node and payload, one row per node, and may have ``part``:
    nodes of the same part are already joined. Inside tasks ``decode()``
    gives a function from a payload to its sorted set, and ``prepare()``, if any, one from
    the sets of a task to the ``likely`` of :func:`links`.
    """
    part = "part" if "part" in members.columns else "node"
    members = stored(members.select("cluster", "node", "payload", F.col(part).alias("part")), f"{name}-members")
    ranked = [F.min(F.struct(F.xxhash64("node", F.lit(s)).alias("h"), "node"))["node"] for s in range(_LEADERS)]
    plan = stored(
        members.groupBy("cluster")
        .agg(
            F.ceil(F.sum(F.length("payload")) / _BLOCK_BYTES).cast("int").alias("blocks"),
            F.array(*ranked).alias("leaders"),
        ),
        f"{name}-plan",
    )
    total = plan.agg(F.count(F.lit(1)), F.sum("blocks"), F.max("blocks")).first()
    bins = int(max(1, min(total[1] or 1, 1_000_000)))

    large = F.col("blocks") > 1
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    everywhere = F.array_contains("leaders", F.col("node"))
    block = F.explode(F.when(large & everywhere, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own)))
    # Clusters of one block share tasks; negative numbers keep them apart from the others.
    bin_ = F.when(large, F.xxhash64("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(bins)))
    laid = members.join(plan, "cluster").select(
        "cluster", "node", "payload", "part", bin_.alias("bin"), block.alias("block")
    )

    def first(group: pd.DataFrame) -> pd.DataFrame:
        read, look, found = decode(), prepare() if prepare else None, []
        for _, part in group.groupby("cluster", sort=False):
            if part["part"].nunique() > 1:
                node, sets = part["node"].to_numpy(), [read(p) for p in part["payload"]]
                parts = np.unique(part["part"].to_numpy(), return_inverse=True)[1]
                likely = look(sets) if look else None
                found += [(node[i], node[j]) for i, j in links(sets, percent, parts, likely=likely)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    inner = stored(laid.groupBy("bin", "block").applyInPandas(first, "a long, b long"), f"{name}-links")
    if (total[2] or 0) <= 1:
        return inner

    # Second step, for cut clusters: what is outside the largest part meets every block.
    wide = members.join(plan.filter(large), "cluster").withColumn("own", own)
    known = wide.select(F.col("node").alias("a"), F.col("part").alias("b"))
    joined = connect(inner.unionByName(known), f"{name}-parts")
    wide = stored(
        wide.join(joined, "node", "left").select(
            "cluster", "node", "payload", "own", F.coalesce("component", "node").alias("part")
        ),
        f"{name}-wide",
    )
    sizes = wide.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("n", "part"))["part"].alias("largest"))
    asking = wide.join(largest, "cluster").filter("part <> largest")
    rounds = asking.groupBy("cluster").agg(
        F.ceil(F.sum(F.length("payload")) / _BLOCK_BYTES).cast("int").alias("rounds")
    )
    turn = F.pmod(F.xxhash64("node", F.lit("turn")), F.col("rounds")).cast("int")
    blocks = plan.filter(large).select("cluster", "blocks")
    sides = (
        wide.join(rounds, "cluster")
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)))
        .select("cluster", F.col("own").alias("block"), "turn", "node", "payload", "part", F.lit(False).alias("asks"))
        .unionByName(
            asking.join(rounds, "cluster")
            .join(blocks, "cluster")
            .withColumn("turn", turn)
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("cluster", "block", "turn", "node", "payload", "part", F.lit(True).alias("asks"))
        )
    )

    def second(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("asks", ascending=False, kind="stable").drop_duplicates("node")
        read = decode()
        node, sets = group["node"].to_numpy(), [read(p) for p in group["payload"]]
        likely = prepare()(sets) if prepare else None
        parts = np.unique(group["part"].to_numpy(), return_inverse=True)[1]
        found = links(sets, percent, parts, group["asks"].to_numpy(), likely)
        return pd.DataFrame([(node[i], node[j]) for i, j in found], columns=["a", "b"], dtype="int64")

    outer = sides.groupBy("cluster", "block", "turn").applyInPandas(second, "a long, b long")
    return inner.unionByName(stored(outer, f"{name}-outer-links"))
