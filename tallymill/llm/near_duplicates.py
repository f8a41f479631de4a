"""Near-duplicate documents: banded MinHash, sequential Bayesian pruning, exact sets.

1. Documents with the same set of word shingles are one node; everything below works on
   nodes, so exact copies cost one row each however many there are.
2. A node's signature is cut into bands; nodes that agree on a band share a bucket. With
   ``bands`` bands of ``width`` hashes a pair of similarity ``s`` shares none with
   probability ``(1 - s**width)**bands``: 5e-6 at 0.75 for the defaults.
3. A bucket first proposes pairs of its members with one of them (its leader). Verified
   links are joined to components. Buckets that still hold several of them are brought
   together into clusters, and each cluster is worked off inside tasks, block by block, by
   steps 4 and 5; only links that join components become rows. So a group of copies costs a
   pair per member, one of documents just below the threshold no more, and no pair is left out.
4. A proposed pair's signatures are compared in batches. After ``n`` hashes with ``m``
   matches the posterior of the similarity under a flat prior is a beta distribution, and
   the pair is dropped when the chance of reaching the threshold is below ``miss``.
5. Survivors are verified on the full shingle sets.

Texts are split at ASCII white space after lowering A to Z. A text with fewer words than
a shingle has its whole sequence as its only one. A text without words, or null, has an
empty set and is linked with nothing. Very long texts are read whole. Rows that repeat in id
and text have the same result each; rows that share an id but not the text are linked only if
their sets are. Null ids take part, and are the smallest only of a group without other ids.
An empty table has no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.clusters import link_clusters
from tallymill.llm.components import connect
from tallymill.llm.registry import query, table
from tallymill.session import stored


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (xor-shifts and odd products)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, words: int):
        self.words = words
        random = np.random.default_rng(5)
        self._factors = random.integers(1, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        # A to Z count as a to z; bytes of white space are in no word.
        byte = np.frombuffer(bytes(range(256)).lower(), np.uint8)
        self._of_byte = random.integers(1, 2**63, 256, dtype=np.uint64)[byte]
        self._inside = np.array([not bytes([i]).isspace() for i in range(256)])
        self._base = random.integers(1, 2**63, 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._powers = np.ones(1, np.uint64)

    def word_hashes(self, text: str | None) -> np.ndarray:
        """One hash per word: a polynomial of its bytes, scrambled."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        inside = self._inside[raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        if not len(edges):
            return np.zeros(0, np.uint64)
        lengths = edges[1::2] - edges[::2]
        starts = np.cumsum(lengths) - lengths
        if lengths.max() > len(self._powers):
            self._powers = np.cumprod(np.append(np.uint64(1), np.repeat(self._base, int(lengths.max()))))
        values = self._of_byte[raw[inside]] * self._powers[np.arange(lengths.sum()) - np.repeat(starts, lengths)]
        return _mixed(np.add.reduceat(values, starts))

    def __call__(self, text: str | None) -> np.ndarray:
        hashes = self.word_hashes(text)
        size = min(len(hashes), self.words)
        if not size:
            return hashes
        count = len(hashes) - size + 1
        total = np.full(count, size, np.uint64)
        for i in range(size):
            total += hashes[i : i + count] * self._factors[i]
        found = np.sort(_mixed(total))
        return found[np.append(True, found[1:] != found[:-1])]


class Signer:
    """MinHash signatures of ``size`` 32-bit values."""

    def __init__(self, size: int):
        random = np.random.default_rng(9)
        self._a = random.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._b = random.integers(0, 2**63, size, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self._a), np.uint64(2**64 - 1))
        for at in range(0, len(shingles), 1024):
            part = shingles[at : at + 1024, None] * self._a + self._b
            least = np.minimum(least, part.min(axis=0))
        return (least >> np.uint64(32)).astype("<u4")


def least_matches(hashes: int, batch: int, threshold: float, miss: float) -> list[tuple[int, int]]:
    """For every number of hashes seen, the fewest matches that keep a pair.

    With a flat prior the chance that the similarity reaches ``t`` after ``m`` matches in
    ``n`` is that of at most ``m`` successes in ``n + 1`` draws of probability ``t``.
    """
    out = []
    for n in [*range(batch, hashes, batch), hashes]:
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def row_name(doc: Column, text: Column) -> list[Column]:
    """``doc`` and ``spot``, which tell rows apart: the id as text, empty for null, and the text's hash."""
    return [F.coalesce(doc.cast("long").cast("string"), F.lit("")).alias("doc"), F.xxhash64(text).alias("spot")]


def number_of(doc: str) -> Column:
    """The id of a row name."""
    return F.when(F.col(doc) != "", F.col(doc).cast("long"))


def node_of(found: np.ndarray) -> int | None:
    """A 64-bit hash of a set; none for an empty one."""
    if not len(found):
        return None
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True)


def _sets(rows: DataFrame, words: int, size: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, signer = Shingler(words), Signer(size)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part, out = batch.iloc[at : at + 1000], []
                for doc, spot, text in zip(part["doc"], part["spot"], part["text"], strict=True):
                    found = shingler(text)
                    signature = signer(found).tobytes() if len(found) else None
                    out.append((doc, spot, len(found), node_of(found), signature))
                frame = pd.DataFrame(out, columns=["doc", "spot", "n_shingles", "node", "signature"])
                # With a null among them, whole numbers would become floating point first.
                yield frame.assign(node=pd.array([row[3] for row in out], dtype="Int64"))

    return rows.mapInPandas(run, "doc string, spot long, n_shingles long, node long, signature binary")


def _shingles(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                yield pd.DataFrame(
                    {"node": part["node"], "shingles": [shingler(t).tobytes() for t in part["text"]]}
                )

    return docs.mapInPandas(run, "node long, shingles binary")


def survivors(left: np.ndarray, right: np.ndarray, plan: list[tuple[int, int]]) -> np.ndarray:
    """Rows whose signatures, compared batch by batch, leave a chance of reaching the threshold."""
    alive, matches, begin = np.arange(len(right)), np.zeros(len(right), int), 0
    for n, least in plan:
        mine = left[begin:n] if left.ndim == 1 else left[alive, begin:n]
        matches[alive] += (mine == right[alive, begin:n]).sum(axis=1)
        alive, begin = alive[matches[alive] >= least], n
    return alive


def _likely(pairs: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """Pairs whose signatures leave a chance of reaching the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                sides = (np.frombuffer(b"".join(part[c]), "<u4").reshape(len(part), -1) for c in ("signature_a", "signature_b"))
                kept.append(part.iloc[survivors(*sides, plan)][["a", "b"]])
            yield pd.concat(kept) if kept else batch[["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _exact(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs of which ``100 * intersection >= percent * union`` holds on the full sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["shingles_a"], batch["shingles_b"], strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    percent: int = 75,
    words: int = 5,
    bands: int = 45,
    width: int = 5,
    batch: int = 25,
    miss: float = 1e-6,
    leaders: int = 1,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (its least doc_id).

    ``doc`` and ``spot`` (:func:`row_name`) tell which row it is, and ``keep`` whether it is
    the one of its component with the least id, then the least hash of its text.
    """
    rows = docs.select(*row_name(F.col(key), F.col(text)), F.col(text).alias("text"))
    sets = stored(_sets(rows, words, bands * width), "shingle-sets")
    named = F.struct((F.col("doc") == "").alias("unnamed"), number_of("doc").alias("id"), "spot")
    nodes = stored(
        sets.filter("node is not null")
        .groupBy("node")
        .agg(F.min(named).alias("first"), F.first("signature").alias("signature")),
        "shingle-nodes",
    )

    # Band keys are hashes of the band's bytes and its number.
    cut = [
        F.xxhash64(F.lit(i), F.substring(F.col("signature"), 4 * width * i + 1, 4 * width)) for i in range(bands)
    ]
    banded = nodes.select("node", F.explode(F.array(*cut)).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(banded.join(shared.select("bucket"), "bucket").distinct(), "bucket-members")

    # The texts of nodes that share a bucket, brought together once.
    wanted = (
        members.select("node")
        .distinct()
        .join(nodes.select("node", "first.id", "first.spot"), "node")
        .select("node", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("doc"), "spot")
    )
    held = stored(
        _shingles(rows.join(wanted, ["doc", "spot"]).dropDuplicates(["node"]).select("node", "text"), words),
        "member-shingles",
    )
    signatures = nodes.select("node", "signature")
    plan = least_matches(bands * width, batch, percent / 100, miss)

    def sides(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(
                values.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}")), side
            )
        return pairs

    def verified(pairs: DataFrame) -> DataFrame:
        likely = _likely(sides(pairs, signatures, "signature"), plan)
        return _exact(sides(likely, held, "shingles"), percent)

    def labelled(components: DataFrame | None) -> DataFrame:
        if components is None:
            return members.withColumn("component", F.col("node"))
        return members.join(components, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )

    def open_buckets(components: DataFrame | None) -> DataFrame:
        """The members of the buckets that still hold several components."""
        here = labelled(components)
        mixed = here.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        return stored(here.join(mixed.filter("low < high").select("bucket"), "bucket"), "open-buckets")

    def decode():
        return lambda shingles: np.frombuffer(shingles, np.uint64)

    def prepare():
        signer = Signer(bands * width)

        def on(sets: list[np.ndarray]):
            signed = np.stack([signer(s) for s in sets])
            return lambda i, others: others[survivors(signed[i], signed[others], plan)]

        return on

    components = None
    for turn in range(leaders):
        here = labelled(components) if components is None else open_buckets(components)
        order = F.xxhash64("node", F.lit(turn)) if turn else F.col("node")
        first = here.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "node", "component")).alias("first"))
        pairs = (
            here.join(first, "bucket")
            .filter(F.col("component") != F.col("first.component"))
            .select(F.least("node", "first.node").alias("a"), F.greatest("node", "first.node").alias("b"))
            .distinct()
        )
        found = stored(verified(pairs), "near-links")
        if components is not None:
            found = found.union(components.select(F.col("node").alias("a"), F.col("component").alias("b")))
        components = connect(found, "near-components")

    # The only pair of two members was that of the leader.
    here = open_buckets(components)
    tops = here.groupBy("bucket").agg(F.min("node").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 2")
    ties = connect(here.join(tops, "bucket").select(F.col("node").alias("a"), F.col("top").alias("b")), "near-clusters")
    inside = ties.unionByName(ties.select(F.col("component").alias("node"), "component")).distinct()
    grouped = (
        inside.withColumnRenamed("component", "cluster")
        .join(held, "node")
        .join(components, "node", "left")
        .select("cluster", "node", F.col("shingles").alias("payload"), F.coalesce("component", "node").alias("part"))
    )
    found = link_clusters(grouped, decode, percent, prepare, "near")
    components = connect(
        found.union(components.select(F.col("node").alias("a"), F.col("component").alias("b"))), "near-components"
    )

    parts = nodes.join(components, "node", "left").select("node", "first", F.coalesce("component", "node").alias("part"))
    least = parts.groupBy("part").agg(F.min("first").alias("least"))
    best = stored(parts.join(least, "part").select("node", "least"), "near-best")
    linked = sets.filter("node is not null").join(best, "node")
    alone = sets.filter("node is null").withColumn("least", named)
    return linked.select("doc", "spot", "n_shingles", "least").unionByName(
        alone.select("doc", "spot", "n_shingles", "least")
    ).select(
        number_of("doc").alias("doc_id"),
        "n_shingles",
        F.col("least.id").alias("component_id"),
        "doc",
        "spot",
        (F.struct((F.col("doc") == "").alias("unnamed"), number_of("doc").alias("id"), "spot") == F.col("least")).alias("keep"),
    )


@query("op7_bayesian_minhash")
def op7_bayesian_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component, and whether it is the one to keep."""
    found = near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
