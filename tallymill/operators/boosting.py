"""Boosted regression trees of many groups at once.

Every group has its own trees, for every setting of a grid, yet the number of jobs does not
depend on how many groups or settings there are:

* rows become numbered bins, with bin edges from each group's own quantiles, and are laid out
  once in chunks of at most ``chunk_rows`` rows;
* the groups that fit one chunk grow all their trees in the task that holds it;
* the others grow level by level: each task adds up residuals by setting, node, feature and
  bin over its chunks, the sums meet per group and the best split of every node of every
  group and setting is chosen in the same job. So a group with a third of the rows is as
  many tasks as it has chunks, and only sums are shuffled.

Both ways choose the same splits: least squared error, ties to the first feature and the
lowest edge. A tree predicts the mean residual of its leaf; the prediction of a group is its
mean plus ``stepSize`` times each tree. Rows and features are drawn anew for each tree by
hash, so a rerun draws the same. A missing value goes to the right of every split.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.session import stored

_DEFAULTS = {
    "maxDepth": 5,
    "stepSize": 0.1,
    "maxIter": 20,
    "minInstancesPerNode": 1,
    "subsamplingRate": 1.0,
    "featureRate": 1.0,
    "l2": 0.0,
}
_TREES = "array<struct<round:int,node:int,feature:int,bin:int,threshold:double,value:double>>"
_LEAST_GAIN = 1e-12


def _uniform(x: np.ndarray, turn: int) -> np.ndarray:
    """Numbers in [0, 1) by hash of 64-bit integers and a turn."""
    x = x.astype(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % 2**64)
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)).astype(float) / 2**53


def _drawn(features: int, rate: float, turn: int) -> np.ndarray:
    """Which features tree number ``turn`` may use."""
    order = np.argsort(_uniform(np.arange(features), 1000 + turn), kind="stable")
    kept = np.zeros(features, bool)
    kept[order[: max(1, round(rate * features))]] = True
    return kept


class Tree:
    """Nodes in heap order: node 1 is the root, node ``n`` has children ``2n`` and ``2n + 1``."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1)
        self.depth = depth
        self.feature, self.bin = np.full(size, -1), np.zeros(size, np.int64)
        self.threshold, self.value = np.zeros(size), np.zeros(size)

    def nodes(self, right) -> np.ndarray:
        """The node that each row ends in; ``right(rows, features, nodes)`` tells its way."""
        at, rows = right.start(), np.arange(len(right))
        for _ in range(self.depth):
            split = rows[self.feature[at] >= 0]
            if not len(split):
                break
            at[split] = 2 * at[split] + right(split, self.feature[at[split]], self, at[split])
        return at


class Binned:
    """Ways of rows given as bin numbers."""

    def __init__(self, bins: np.ndarray):
        self.bins = bins

    def __len__(self) -> int:
        return len(self.bins)

    def start(self) -> np.ndarray:
        return np.ones(len(self.bins), np.int64)

    def __call__(self, rows, features, tree, nodes):
        return self.bins[rows, features] > tree.bin[nodes]


class Valued(Binned):
    """Ways of rows given as values."""

    def __call__(self, rows, features, tree, nodes):
        return ~(self.bins[rows, features] <= tree.threshold[nodes])


def node_sums(bins: np.ndarray, residual: np.ndarray, node: np.ndarray, frontier: Sequence[int], width: int):
    """(count, sum) of the residuals by frontier node, feature and bin."""
    features = bins.shape[1]
    place = np.full(max([*frontier, int(node.max(initial=0))]) + 1, -1)
    place[list(frontier)] = np.arange(len(frontier))
    rows = np.flatnonzero(place[node] >= 0)
    slot = (place[node[rows]][:, None] * features + np.arange(features)) * width + bins[rows]
    size = len(frontier) * features * width
    counts = np.bincount(slot.ravel(), minlength=size)
    sums = np.bincount(slot.ravel(), weights=np.repeat(residual[rows], features), minlength=size)
    shape = (len(frontier), features, width)
    return counts.astype(float).reshape(shape), sums.reshape(shape)


def best_split(counts: np.ndarray, sums: np.ndarray, least: int, l2: float, allowed: np.ndarray):
    """(feature, bin, left value, right value) of one node, or None where no split gains."""
    left_n, left_s = counts.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
    n, s = counts[0].sum(), sums[0].sum()
    right_n, right_s = n - left_n, s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s**2 / (left_n + l2) + right_s**2 / (right_n + l2) - s**2 / (n + l2)
    gain[~allowed] = -1
    gain[(left_n < max(1, least)) | (right_n < max(1, least))] = -1
    if not gain.size or gain.max() <= _LEAST_GAIN * max(1.0, s**2 / max(1.0, n)):
        return None
    # Sums of equal rows differ by rounding; the first of nearly equal gains counts.
    feature, at = np.unravel_index(np.flatnonzero(gain >= gain.max() * (1 - 1e-10))[0], gain.shape)
    return (
        int(feature),
        int(at),
        left_s[feature, at] / (left_n[feature, at] + l2),
        right_s[feature, at] / (right_n[feature, at] + l2),
    )


def _rows_of(trees: Sequence[Tree]) -> list[dict]:
    out = []
    for turn, tree in enumerate(trees):
        pending = [1]
        while pending:
            n = pending.pop()
            split = tree.feature[n] >= 0
            out.append(
                {
                    "round": turn,
                    "node": n,
                    "feature": int(tree.feature[n]),
                    "bin": int(tree.bin[n]),
                    "threshold": float(tree.threshold[n]),
                    "value": float(tree.value[n]),
                }
            )
            pending += [2 * n, 2 * n + 1] if split else []
    return out


def _trees_of(rows, depth: int) -> dict[int, Tree]:
    """Trees by round from their node rows; a node's split counts before its value."""
    trees: dict[int, Tree] = {}
    for r in rows:
        tree = trees.setdefault(r["round"], Tree(depth))
        n = r["node"]
        if r["feature"] >= 0:
            tree.feature[n], tree.bin[n], tree.threshold[n] = r["feature"], r["bin"], r["threshold"]
        else:
            tree.value[n] = r["value"]
    return trees


def _grow(chunk: "Chunk", params: Mapping) -> tuple[list[Tree], list[float]]:
    """All trees of a group that one chunk holds, and the mean absolute error held out after each."""
    prediction, trees, errors = np.full(len(chunk), chunk.base), [], []
    binned = Binned(chunk.bins)
    for turn in range(params["maxIter"]):
        tree = Tree(params["maxDepth"])
        used = chunk.learns & (_uniform(chunk.hash, turn) < params["subsamplingRate"])
        allowed = _drawn(chunk.bins.shape[1], params["featureRate"], turn)
        bins, residual = chunk.bins[used], (chunk.y - prediction)[used]
        node, frontier = np.ones(len(bins), np.int64), [1]
        tree.value[1] = residual.sum() / max(1e-300, len(residual) + params["l2"])
        for _ in range(params["maxDepth"]):
            if not frontier or not len(bins):
                break
            counts, sums = node_sums(bins, residual, node, frontier, chunk.width)
            made = []
            for i, n in enumerate(frontier):
                found = best_split(counts[i], sums[i], params["minInstancesPerNode"], params["l2"], allowed)
                if found is not None:
                    feature, at, left, right = found
                    tree.feature[n], tree.bin[n], tree.threshold[n] = feature, at, chunk.edges[feature][at]
                    tree.value[2 * n], tree.value[2 * n + 1] = left, right
                    inside = node == n
                    node[inside] = 2 * n + (bins[inside, feature] > at)
                    made += [2 * n, 2 * n + 1]
            frontier = made
        prediction = prediction + params["stepSize"] * tree.value[tree.nodes(binned)]
        trees.append(tree)
        held = ~chunk.learns
        errors.append(float(np.abs(chunk.y - prediction)[held].mean()) if held.any() else float("nan"))
    return trees, errors


class Chunk:
    """Rows of one group as arrays, from a row of the chunk table."""

    def __init__(self, row):
        self.y = np.frombuffer(row["y"], float)
        self.learns = np.frombuffer(row["learns"], bool)
        self.hash = np.frombuffer(row["hash"], np.int64)
        self.edges = [np.asarray(e, float) for e in row["edges"]]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(len(self.y), len(self.edges))
        self.width = max([len(e) for e in self.edges]) + 1
        self.base = row["base"]

    def __len__(self) -> int:
        return len(self.y)


def _edges(column: Column, bins: int) -> Column:
    """Middles between at most ``bins`` quantiles of a column, denser ones thinned out."""
    levels = [i / (4 * bins) for i in range(4 * bins + 1)]
    values = F.array_distinct(F.percentile_approx(column, F.array(*map(F.lit, levels)), F.lit(2_000)))
    values = F.array_sort(F.filter(F.coalesce(values, F.array().cast("array<double>")), lambda v: ~F.isnan(v)))
    step = F.greatest(F.lit(1.0), F.size(values) / bins)
    count = F.least(F.size(values), F.lit(bins))
    picked = F.when(
        F.size(values) > 0,
        F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.element_at(values, F.least(F.size(values), F.ceil(i * step)).cast("int")),
        ),
    ).otherwise(F.array().cast("array<double>"))
    return F.when(
        F.size(picked) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(picked) - 1),
            lambda i: (F.element_at(picked, i) + F.element_at(picked, i + 1)) / 2,
        ),
    ).otherwise(F.array().cast("array<double>"))


def lay_out(
    df: DataFrame,
    groups: Sequence[str],
    features: Sequence[str],
    target: str,
    order: Sequence[str],
    held: Column | None = None,
    bins: int = 32,
    chunk_rows: int = 20_000,
) -> DataFrame:
    """Chunks of binned rows, one table row each, with their group's edges and mean.

    Rows without a group or a target are left out. ``held`` marks rows that are only used
    to measure errors. ``order`` names columns that tell rows of a group apart; rows that
    share them are drawn together.
    """
    groups = list(groups)
    learns = F.lit(True) if held is None else ~F.coalesce(held, F.lit(False))
    rows = df.dropna(subset=[*groups, target]).select(
        *groups,
        F.xxhash64(*order).alias("_hash"),
        F.col(target).cast("double").alias("_y"),
        learns.alias("_learns"),
        F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features]).alias("_x"),
    )
    known = F.col("_learns")
    shape = rows.groupBy(*groups).agg(
        F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias("chunks"),
        F.coalesce(F.avg(F.when(known, F.col("_y"))), F.lit(0.0)).alias("base"),
        F.array(*[_edges(F.when(known, F.col("_x")[i]), bins) for i in range(len(features))]).alias("edges"),
    )
    shape = stored(shape, "boosting-shape")
    cut = rows.join(shape.select(*groups, "chunks"), groups).withColumn(
        "_chunk", F.pmod(F.xxhash64("_hash"), F.col("chunks")).cast("int")
    ).drop("chunks")
    per_chunk = shape.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    # Fresh columns: both sides come from the same table.
    per_chunk = per_chunk.toDF(*per_chunk.columns)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*groups).schema)
    schema = f"{names}, chunks int, base double, edges array<array<double>>, bins binary, y binary, learns binary, hash binary"

    def pack(rows: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        out = info[[*groups, "chunks", "base", "edges"]].copy()
        if not len(rows):
            return out.iloc[:0].assign(bins=None, y=None, learns=None, hash=None)
        rows = rows.sort_values("_hash", kind="stable")
        x = np.stack(rows["_x"].to_numpy())
        place = [np.searchsorted(np.asarray(e, float), x[:, i]) for i, e in enumerate(info["edges"].iloc[0])]
        return out.assign(
            bins=[np.stack(place, axis=1).astype(np.uint8).tobytes()],
            y=[rows["_y"].to_numpy(float).tobytes()],
            learns=[rows["_learns"].to_numpy(bool).tobytes()],
            hash=[rows["_hash"].to_numpy(np.int64).tobytes()],
        )

    keys = [*groups, "_chunk"]
    packed = cut.groupBy(*keys).cogroup(per_chunk.groupBy(*keys)).applyInPandas(pack, schema)
    return stored(packed, "boosting-chunks")


def fit_boosted(
    chunks: DataFrame, groups: Sequence[str], settings: Sequence[Mapping], wanted: DataFrame | None = None
) -> DataFrame:
    """Trees of every group and setting.

    ``chunks`` is the result of :func:`lay_out`. ``wanted`` (the groups and ``settings``, an
    array of numbers) leaves out other groups and settings. One row per group and setting:
    the number of the setting, its ``step`` and ``depth``, ``base``, ``trees`` (their nodes)
    and ``errors``, the mean absolute error on held rows after each tree.
    """
    groups = list(groups)
    settings = [{**_DEFAULTS, **s} for s in settings]
    if wanted is None:
        chunks = chunks.withColumn("settings", F.lit(list(range(len(settings)))))
    else:
        chunks = chunks.join(wanted.select(*groups, "settings"), groups)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.select(*groups).schema)
    known = chunks.sparkSession.createDataFrame(
        [(i, float(s["stepSize"]), s["maxDepth"]) for i, s in enumerate(settings)], "setting int, step double, depth int"
    )

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                chunk = Chunk(row)
                for number in row["settings"]:
                    trees, errors = _grow(chunk, settings[number])
                    yield pd.DataFrame(
                        {
                            **{g: [row[g]] for g in groups},
                            "setting": [number],
                            "base": [chunk.base],
                            "trees": [_rows_of(trees)],
                            "errors": [errors],
                        }
                    )

    small = chunks.filter("chunks = 1").repartition(*groups).mapInPandas(
        alone, f"{names}, setting int, base double, trees {_TREES}, errors array<double>"
    )
    small = stored(small, "boosted-small")
    large = chunks.filter("chunks > 1")
    if not large.isEmpty():
        small = small.unionByName(_by_level(large, groups, settings, names))
    return small.join(F.broadcast(known), "setting")


def _by_level(chunks: DataFrame, groups: list[str], settings: list[dict], names: str) -> DataFrame:
    """The same for groups of many chunks: one job per tree level."""
    spark = chunks.sparkSession
    depth = max(s["maxDepth"] for s in settings)
    node_schema = f"{names}, setting int, round int, node int, feature int, bin int, threshold double, value double"
    shape = stored(chunks.groupBy(*groups).agg(F.first("edges").alias("edges"), F.first("base").alias("base")), "shape")
    nodes = spark.createDataFrame([], node_schema)
    node = F.struct("setting", "round", "node", "feature", "bin", "threshold", "value")

    def with_trees(table: DataFrame) -> DataFrame:
        grown = nodes.groupBy(*groups).agg(F.collect_list(node).alias("grown"))
        return table.join(grown, groups, "left")

    def state(row, chunk: Chunk, number: int, turn: int) -> tuple[np.ndarray, np.ndarray, Tree]:
        """Prediction after the whole trees, and the node of each row in tree ``turn``."""
        mine = [r for r in (row["grown"] if row["grown"] is not None else []) if r["setting"] == number]
        trees, binned = _trees_of(mine, depth), Binned(chunk.bins)
        prediction = np.full(len(chunk), chunk.base)
        for t in range(turn):
            if t in trees:
                prediction += settings[number]["stepSize"] * trees[t].value[trees[t].nodes(binned)]
        current = trees.get(turn, Tree(depth))
        return prediction, current.nodes(binned), current

    for turn in range(max(s["maxIter"] for s in settings)):
        for level in range(depth):
            active = [i for i, s in enumerate(settings) if turn < s["maxIter"] and level < s["maxDepth"]]

            # Both run before the loop goes on, so they see this round and level.
            def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                held: dict = {}
                for batch in batches:
                    for _, row in batch.iterrows():
                        chunk, key = Chunk(row), tuple(row[g] for g in groups)
                        for number in set(active).intersection(row["settings"]):
                            prediction, node, tree = state(row, chunk, number, turn)
                            frontier = [
                                n
                                for n in range(2**level, 2 ** (level + 1))
                                if n == 1 or tree.feature[n // 2] >= 0
                            ]
                            if not frontier:
                                continue
                            used = chunk.learns & (
                                _uniform(chunk.hash, turn) < settings[number]["subsamplingRate"]
                            )
                            counts, sums = node_sums(
                                chunk.bins[used], (chunk.y - prediction)[used], node[used], frontier, chunk.width
                            )
                            for n, c, s in zip(frontier, counts, sums, strict=True):
                                old = held.get((key, number, n), (0.0, 0.0))
                                held[key, number, n] = (old[0] + c, old[1] + s)
                for (key, number, n), (c, s) in held.items():
                    slots = np.flatnonzero(c)
                    yield pd.DataFrame(
                        {
                            **{g: [v] * len(slots) for g, v in zip(groups, key, strict=True)},
                            "setting": number,
                            "node": n,
                            "slot": slots,
                            "n": c.ravel()[slots],
                            "s": s.ravel()[slots],
                        }
                    )

            def choose(key, sums: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
                columns = [*groups, "setting", "round", "node", "feature", "bin", "threshold", "value"]
                out = []
                if len(sums) and len(info):
                    edges = info["edges"].iloc[0]
                    width = max(len(e) for e in edges) + 1
                    for (number, n), part in sums.groupby(["setting", "node"]):
                        params, shape_ = settings[number], (len(edges), width)
                        c, s = np.zeros(shape_), np.zeros(shape_)
                        c.ravel()[part["slot"]], s.ravel()[part["slot"]] = part["n"], part["s"]
                        allowed = _drawn(len(edges), params["featureRate"], turn)
                        if n == 1:
                            out.append((*key, number, turn, 1, -1, 0, 0.0, s[0].sum() / (c[0].sum() + params["l2"])))
                        found = best_split(c, s, params["minInstancesPerNode"], params["l2"], allowed)
                        if found is not None:
                            feature, at, left, right = found
                            out.append((*key, number, turn, n, feature, at, float(edges[feature][at]), 0.0))
                            out.append((*key, number, turn, 2 * n, -1, 0, 0.0, left))
                            out.append((*key, number, turn, 2 * n + 1, -1, 0, 0.0, right))
                return pd.DataFrame(out, columns=columns)

            partial = with_trees(chunks).mapInPandas(
                add, f"{names}, setting int, node int, slot int, n double, s double"
            )
            total = partial.groupBy(*groups, "setting", "node", "slot").agg(
                F.sum("n").alias("n"), F.sum("s").alias("s")
            )
            made = total.groupBy(*groups).cogroup(shape.groupBy(*groups)).applyInPandas(choose, node_schema)
            nodes = stored(nodes.unionByName(made), "boosted-nodes")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                chunk = Chunk(row)
                held, binned = ~chunk.learns, Binned(chunk.bins)
                for number in row["settings"]:
                    params = settings[number]
                    mine = [r for r in row["grown"] if r["setting"] == number]
                    trees, prediction = _trees_of(mine, depth), np.full(len(chunk), chunk.base)
                    for turn in range(params["maxIter"]):
                        if turn in trees:
                            prediction += params["stepSize"] * trees[turn].value[trees[turn].nodes(binned)]
                        error = float(np.abs(chunk.y - prediction)[held].sum())
                        yield pd.DataFrame(
                            {
                                **{g: [row[g]] for g in groups},
                                "setting": [number],
                                "round": [turn],
                                "n": [int(held.sum())],
                                "error": [error],
                            }
                        )

    errors = (
        with_trees(chunks)
        .mapInPandas(measure, f"{names}, setting int, round int, n long, error double")
        .groupBy(*groups, "setting", "round")
        .agg((F.sum("error") / F.nullif(F.sum("n"), F.lit(0))).alias("error"))
        .groupBy(*groups, "setting")
        .agg(F.array_sort(F.collect_list(F.struct("round", F.coalesce("error", F.lit(float("nan"))).alias("e")))).alias("_e"))
        .select(*groups, "setting", F.transform("_e", lambda x: x["e"]).alias("errors"))
    )
    trees = nodes.groupBy(*groups, "setting").agg(
        F.collect_list(F.struct("round", "node", "feature", "bin", "threshold", "value")).alias("trees")
    )
    return trees.join(shape.select(*groups, "base"), groups).join(errors, [*groups, "setting"]).select(
        *groups, "setting", "base", "trees", "errors"
    )


def best_rounds(models: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per group the setting and number of trees of least error on held rows.

    Ties go to fewer trees, then to the earlier setting; without held rows the first
    setting keeps all its trees.
    """
    tries = F.transform(
        "errors",
        lambda e, i: F.struct(
            F.when(F.isnan(e), F.lit(0.0)).otherwise(e).alias("error"),
            F.when(F.isnan(e), -i).otherwise(i).alias("order"),
            F.col("setting").alias("setting"),
            (i + 1).alias("rounds"),
        ),
    )
    best = (
        models.withColumn("_best", F.array_min(tries))
        .groupBy(*groups)
        .agg(F.min_by(F.struct("_best", "step", "depth", "base", "trees"), F.col("_best")).alias("_m"))
        .select(*groups, "_m.*")
    )
    return best.select(
        *groups,
        "_best.setting",
        "_best.rounds",
        "_best.error",
        "step",
        "depth",
        "base",
        F.filter("trees", lambda t: t["round"] < F.col("_best.rounds")).alias("trees"),
    )


def predict_boosted(
    df: DataFrame,
    models: DataFrame,
    groups: Sequence[str],
    features: Sequence[str],
    name: str,
    rows: int = 50_000,
) -> DataFrame:
    """``df`` with its group's boosted prediction, null where the group has no model.

    ``models`` has one row per group, as :func:`best_rounds` gives them. Rows meet their
    group's trees in tasks of about ``rows`` rows.
    """
    groups = list(groups)
    parts = stored(
        df.groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_parts")), "boosting-parts"
    )
    numbered = df.withColumn(
        "_x", F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))) for f in features])
    ).join(parts, groups, "left")
    part = F.coalesce(F.pmod(F.xxhash64("_x"), F.col("_parts")), F.lit(0)).cast("int")
    numbered = numbered.withColumn("_part", part).drop("_parts")
    spread = models.join(parts, groups).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    spread = spread.select(*groups, "_part", "step", "depth", "base", "trees")
    spread = spread.toDF(*spread.columns)
    keys = [*groups, "_part"]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        value = pa.nulls(left.num_rows, pa.float64())
        if left.num_rows and right.num_rows:
            model = right.slice(0, 1).to_pylist()[0]
            x = np.stack(left.column("_x").to_numpy(zero_copy_only=False))
            out, valued = np.full(len(x), model["base"]), Valued(x)
            for tree in _trees_of(model["trees"], model["depth"]).values():
                out += model["step"] * tree.value[tree.nodes(valued)]
            value = pa.array(out)
        return left.drop_columns(["_x", "_part"]).append_column(name, value)

    schema = df.withColumn(name, F.lit(None).cast("double")).schema
    return numbered.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(score, schema)
