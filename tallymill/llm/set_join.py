"""N-gram Jaccard join: a size-aware join of heavy and light sets.

A pair at the threshold has so many elements in common that, in any one order of all
elements, the first few of either set already hold some of them: a set of ``n`` elements
must share ``k`` of its first ``n - ceil(percent * n / 100) + k``. The order used here puts
the elements that few documents hold first, so these beginnings are seldom shared by chance.

Small sets, up to a boundary, enumerate the subsets of two elements of their beginning and
meet small sets with an equal subset. Pairs with a large set are found in the inverted lists of
single elements of the beginnings, which large sets scan. The boundary is the one of least
cost: subsets against list rows, each weighted with the mean length of the lists that the
counts of all elements predict.

1. Elements are counted over all documents, added up in each task before the shuffle. Those
   in many documents, heavy ones, are sent to the tasks; at most ``heavy`` of them, so the
   count from which an element is heavy rises with the corpus instead of the table.
2. Lists of light elements are short. Their pairs must fit in size, and the counts of their
   elements in 256 classes must leave room for enough common ones.
3. Lists of heavy elements give no pairs. Their sets are only brought into one cluster, in
   the tasks first: a group of copies of any size costs a row per member.
4. Light pairs that are left and heavy lists form clusters. Inside a cluster whole sets are
   compared exactly, block by block, and only links that join parts become rows.

No pair is given up: 2 and 3 only drop pairs that cannot reach the threshold.

Words are runs without ASCII white space, A to Z lowered. A text with fewer words than a
shingle has its whole sequence as its only element; null texts and texts without words have
none and are linked with nothing. Equal sets are one node. Rows that repeat, in id or text, are
given each; rows that share an id but not the text are linked only if their sets are.
Null ids take part and are never the smallest. Very long texts are read whole. An empty table
has no rows; other columns are ignored. Elements are 64-bit hashes of shingles, and nodes
64-bit hashes of their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.clusters import link_clusters
from tallymill.llm.components import connect
from tallymill.llm.near_duplicates import Shingler, node_of, number_of, row_name
from tallymill.llm.registry import query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

_CLASSES = 256
_ROWS = 1000
# Elements that a task adds up at a time, and that one group of the counting step receives.
_ADDED = 1_000_000
_GROUP = 250_000
_LEAST_HEAVY = 8
_LARGEST_BOUNDARY = 200


def _up(a, b):
    return -(-a // b)


def _buckets(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``bits`` bits of 64-bit keys, and the 32 bits after them."""
    group = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    return group, (keys >> np.uint64(32 - bits)).astype(np.uint32)


def _pieces(group: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """Every group with its values as bytes."""
    order = np.argsort(group, kind="stable")
    group, values = group[order], [v[order] for v in values]
    cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
    for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(group[begin]), *(v[begin:end].tobytes() for v in values)


def _joined(values: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind)


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(doc, spot, n, node, classes): the set's size and hash, and its elements per class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part, out = batch.iloc[at : at + _ROWS], []
                for doc, spot, text in zip(part["doc"], part["spot"], part["text"], strict=True):
                    found = shingler(text)
                    counts = np.bincount((found & np.uint64(_CLASSES - 1)).astype(np.int64), minlength=_CLASSES)
                    # Too many for a byte: no bound, such sets are compared whole.
                    classes = counts.astype(np.uint8).tobytes() if counts.max() < 256 else None
                    out.append((doc, spot, len(found), node_of(found), classes))
                frame = pd.DataFrame(out, columns=["doc", "spot", "n", "node", "classes"])
                # With a null among them, whole numbers would become floating point first.
                yield frame.assign(node=pd.array([row[3] for row in out], dtype="Int64"))

    return rows.mapInPandas(run, "doc string, spot long, n long, node long, classes binary")


def _counts(rows: DataFrame, words: int, bits: int) -> DataFrame:
    """(element, n) of the elements that ``_LEAST_HEAVY`` documents hold.

    One row per group without an element has the sums of all counts and of their squares.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)

        def added(held):
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            group, low = _buckets(keys, bits)
            return pd.DataFrame(_pieces(group, low, counts.astype(np.uint32)), columns=["bucket", "keys", "counts"])

        for batch in batches:
            held, size = [], 0
            for text in batch["text"]:
                held.append(shingler(text))
                size += len(held[-1])
                if size >= _ADDED:
                    yield added(held)
                    held, size = [], 0
            if size:
                yield added(held)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _joined(group["keys"], np.uint32), _joined(group["counts"], np.uint32)
        known, number = np.unique(keys, return_inverse=True)
        sums = np.bincount(number, weights=counts).astype(np.int64)
        often = sums >= _LEAST_HEAVY
        element = (int(group["bucket"].iloc[0]) << 32) + known[often].astype(np.int64)
        out = pd.DataFrame({"element": element, "n": sums[often], "squares": 0.0})
        light = sums[~often].astype(float)
        summary = pd.DataFrame({"element": [-1], "n": [int(light.sum())], "squares": [float((light**2).sum())]})
        return pd.concat([summary, out])

    return (
        rows.select("text")
        .mapInPandas(add, "bucket int, keys binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(total, "element long, n long, squares double")
    )


class Beginnings:
    """The elements, or pairs of elements, by which a set is found."""

    def __init__(self, percent: int, boundary: int, heavy: np.ndarray, counts: np.ndarray, bits: int):
        order = np.argsort(heavy)
        self.percent, self.boundary, self.bits = percent, boundary, bits
        self.heavy, self.counts = heavy[order], counts[order]

    def ordered(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The set in the common order, and how often its heavy elements occur (others: 0)."""
        often = np.zeros(len(found), np.int64)
        if len(self.heavy):
            short = (found >> np.uint64(32 - self.bits)).astype(np.int64)
            at = np.minimum(np.searchsorted(self.heavy, short), len(self.heavy) - 1)
            often = np.where(self.heavy[at] == short, self.counts[at], 0)
        order = np.lexsort((found, often))
        return found[order], often[order]

    def keys(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, whether a key is heavy, and whether it counts for partners at least as large."""
        n, percent = len(found), self.percent
        element, often = self.ordered(found)
        spare = n - _up(percent * n, 100)
        near = n - _up(2 * percent * n, 100 + percent)
        keys, heavy, index = [], [], []
        if n <= self.boundary:
            first, second = np.triu_indices(min(n, spare + 2), 1)
            keys.append((element[first] ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93) + element[second])
            heavy.append((often[first] > 0) & (often[second] > 0))
            index.append(second <= near + 1)
        if 100 * n >= percent * (self.boundary + 1):
            keys.append(element[: spare + 1])
            heavy.append(often[: spare + 1] > 0)
            index.append(np.arange(len(keys[-1])) <= near)
        return tuple(np.concatenate(v) for v in (keys, heavy, index))


def boundary_of(sizes: dict[int, int], percent: int, length: float) -> int:
    """The largest small set: subsets of small sets against list rows of the others."""
    best, least = 0, None
    subsets, at = 0, sorted(sizes)
    for x in range(_LARGEST_BOUNDARY + 1):
        subsets += sizes.get(x, 0) * ((x - _up(percent * x, 100) + 2) * (x - _up(percent * x, 100) + 1) // 2)
        listed = sum(
            sizes[n] * (n - _up(percent * n, 100) + 1) for n in at if 100 * n >= percent * (x + 1)
        )
        cost = subsets + listed * (1 + length)
        if least is None or cost < least:
            best, least = x, cost
    return best


# What a row of _met holds before the shuffle: entries of light lists, heavy keys with a
# node of their part, or nodes with that node.
_LIGHT, _KEYS, _NODES = 0, 1, 2


def _tied(heavy: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, roots) and (nodes, roots): nodes that share heavy keys, step by step, get one root."""
    keys, nodes = np.concatenate([k for k, _ in heavy]), np.array([n for _, n in heavy])
    owner = np.repeat(np.arange(len(heavy)), [len(k) for k, _ in heavy])
    known, number = np.unique(keys, return_inverse=True)
    part = np.arange(len(heavy))
    while True:
        least = np.full(len(known), len(heavy))
        np.minimum.at(least, number, part[owner])
        new = part.copy()
        np.minimum.at(new, owner, least[number])
        new = new[new]
        if (new == part).all():
            break
        part = new
    ties = np.unique(np.stack([number, part[owner]]), axis=1)
    return known[ties[0]], nodes[part[ties[1]]], nodes, nodes[part]


def _pairs(keys: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of nodes with an equal key whose sizes, and the place of the key, leave a chance."""
    order = np.lexsort((nodes, keys))
    keys, nodes, sizes = keys[order], nodes[order], sizes[order]
    fresh = np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))
    keys, nodes, sizes = keys[fresh], nodes[fresh], sizes[fresh]
    size, index = (sizes >> 1).astype(np.int64), (sizes & 1).astype(bool)
    ends = np.searchsorted(keys, keys, side="right")
    left, step, found = np.arange(len(keys)), 1, [np.zeros((2, 0), np.int64)]
    while True:
        left = left[left + step < ends[left]]
        if not len(left):
            return np.unique(np.concatenate(found, axis=1), axis=1)
        right = left + step
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        # The key must be within the shorter beginning that the smaller set needs.
        counts = np.where(size[left] <= size[right], index[left], index[right])
        counts &= (size[left] != size[right]) | index[right]
        fits = counts & (100 * small >= percent * large)
        found.append(np.stack([nodes[left[fits]], nodes[right[fits]]]))
        step += 1


def _met(rows: DataFrame, words: int, get, bits: int, percent: int) -> DataFrame:
    """(sure, a, b): links of heavy lists into clusters, and pairs of light lists to look at."""

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, begin = Shingler(words), get()
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                light, heavy, seen, out = [], [], set(), []
                for text in batch["text"].iloc[at : at + _ROWS]:
                    found = shingler(text)
                    node = node_of(found)
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    keys, often, index = begin.keys(found)
                    size = (len(found) << 1) + index[~often]
                    light.append((keys[~often], np.full(len(size), node), size))
                    if often.any():
                        heavy.append((keys[often], node))
                if light:
                    keys, nodes, sizes = (np.concatenate(v) for v in zip(*light, strict=True))
                    group, low = _buckets(keys, bits)
                    out += [(_LIGHT, *p) for p in _pieces(group, low, nodes, sizes.astype(np.uint32))]
                if heavy:
                    keys, roots, nodes, tops = _tied(heavy)
                    out += [(_KEYS, *p, b"") for p in _pieces(_buckets(keys, bits)[0], keys, roots)]
                    spread = _buckets(tops.view(np.uint64), bits)[0]
                    out += [(_NODES, *p, b"") for p in _pieces(spread, nodes, tops)]
                yield pd.DataFrame(out, columns=["kind", "bucket", "keys", "nodes", "sizes"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        kinds, out = dict(tuple(group.groupby("kind"))), []
        if _LIGHT in kinds:
            light = kinds[_LIGHT]
            values = _joined(light["keys"], np.uint32), _joined(light["nodes"], np.int64), _joined(light["sizes"], np.uint32)
            out.append((False, _pairs(*values, percent)))
        if _NODES in kinds:
            out.append((True, np.stack([_joined(kinds[_NODES][c], np.int64) for c in ("keys", "nodes")])))
        if _KEYS in kinds:
            keys, roots = _joined(kinds[_KEYS]["keys"], np.uint64), _joined(kinds[_KEYS]["nodes"], np.int64)
            _, first, number = np.unique(keys, return_index=True, return_inverse=True)
            out.append((True, np.stack([roots, roots[first][number]])))
        found = [pd.DataFrame({"sure": sure, "a": e[0], "b": e[1]}) for sure, e in out]
        return pd.concat(found).query("a != b").drop_duplicates()

    return (
        rows.select("text")
        .mapInPandas(lay, "kind int, bucket int, keys binary, nodes binary, sizes binary")
        .groupBy("bucket")
        .applyInPandas(meet, "sure boolean, a long, b long")
    )


def _leave_room(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose elements per class allow enough common ones."""
    for side in ("a", "b"):
        named = nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("classes").alias(f"c_{side}"))
        pairs = pairs.join(named, side)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 10_000):
                part = batch.iloc[at : at + 10_000]
                known = part["c_a"].notna() & part["c_b"].notna()
                some = part[known]
                left, right = (
                    np.frombuffer(b"".join(some[c]), np.uint8).reshape(len(some), _CLASSES) for c in ("c_a", "c_b")
                )
                common = np.minimum(left, right).sum(axis=1, dtype=np.int64)
                keep = 100 * common >= percent * (some["n_a"].to_numpy() + some["n_b"].to_numpy() - common)
                yield pd.concat([some.loc[keep, ["a", "b"]], part.loc[~known, ["a", "b"]]])

    return pairs.mapInPandas(run, "a long, b long")


def heavy_light_join(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    percent: int = 80,
    words: int = 5,
    heavy: int = 2_000_000,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the least id reachable)."""
    spark = docs.sparkSession
    rows = docs.select(*row_name(F.col(key), F.col(text)), F.col(text).alias("text"))
    sets = stored(_sets(rows, words), "join-sets")

    # Sizes are counted up to a bound that no boundary reaches; larger ones count together.
    top = _LARGEST_BOUNDARY * 2
    sizes = {
        r["n"]: r["count"]
        for r in sets.groupBy(F.least("n", F.lit(top)).cast("int").alias("n")).count().filter("n > 0").collect()
    }
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = max(0, int(total / _GROUP).bit_length())
    often = stored(_counts(rows, words, bits), "join-counts")
    light = often.filter("element < 0").agg(F.sum("n"), F.sum("squares")).first()
    length = light[1] / light[0] if light[0] else 1.0
    often = often.filter("element >= 0")
    least = _LEAST_HEAVY
    while often.filter(F.col("n") >= least).count() > heavy:
        least *= 2
    kept = often.filter(F.col("n") >= least).select("element", "n").toPandas()
    begin = Beginnings(
        percent,
        boundary_of(sizes, percent, length),
        kept["element"].to_numpy(np.int64),
        kept["n"].to_numpy(np.int64),
        bits,
    )
    met = stored(_met(rows, words, shared(spark, begin), bits, percent), "join-met")

    nodes = stored(
        sets.filter("node is not null")
        .groupBy("node")
        .agg(
            F.first("n").alias("n"),
            F.first("classes").alias("classes"),
            F.min(F.struct("doc", "spot")).alias("first"),
            F.min(number_of("doc")).alias("least"),
        ),
        "join-nodes",
    )
    near = _leave_room(met.filter("not sure").select("a", "b").distinct(), nodes, percent)
    ties = connect(near.unionByName(met.filter("sure").select("a", "b")), "join-clusters")
    inside = ties.unionByName(ties.select(F.col("component").alias("node"), "component")).distinct()
    members = inside.join(nodes.select("node", "first"), "node").select(
        "node", F.col("component").alias("cluster"), F.col("first.doc").alias("doc"), F.col("first.spot").alias("spot")
    )
    whole = rows.join(members, ["doc", "spot"]).dropDuplicates(["node"])
    payload = whole.select("cluster", "node", F.encode("text", "UTF-8").alias("payload"))

    def decode():
        shingler = Shingler(words)
        return lambda text: shingler(bytes(text).decode("utf-8", "surrogatepass"))

    found = connect(link_clusters(payload, decode, percent, name="join"), "join-components")
    named = nodes.join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("part"))
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    named = stored(named.join(smallest, "part").select("node", "component_id"), "join-named")
    back, count = number_of("doc"), F.col("n").alias("n_shingles")
    full = sets.filter("node is not null").join(named, "node").select(back.alias("doc_id"), count, "component_id")
    bare = sets.filter("node is null").select(back.alias("doc_id"), count, back.alias("component_id"))
    return full.unionByName(bare)


def _sql(percent: int) -> str:
    """DuckDB form: all pairs that share a shingle, then reachability."""
    return rf"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT r, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s
    FROM words WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
    SELECT a, b FROM (
        SELECT x.r AS a, y.r AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r
        GROUP BY x.r, y.r) JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b
    WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reach AS (SELECT r AS a, r AS b FROM sizes UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
best AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN words ON words.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM words LEFT JOIN sizes USING (r) LEFT JOIN best USING (r)
"""


@query("op12_heavy_light", _sql(80))
def op12_heavy_light(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's set size and component."""
    return heavy_light_join(table(spark, folder, "documents"))
