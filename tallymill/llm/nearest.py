"""Largest inner products with randomly rotated one-bit codes.

Every vector is written as its list's centre plus a residual; the residual is rotated by a
random orthogonal matrix and kept as one sign bit per dimension, packed, with two scalars:
the residual's length and its inner product with its own code. A query's inner product
with the code, divided by the second scalar, estimates the inner product without bias, and
the scalars bound its error. In each block of a list only vectors whose upper bound reaches
the k-th best lower bound are scored exactly on the original vectors.

Centres are fitted on a bounded hash sample of ``sample`` vectors; every vector is indexed.
How many lists a query visits is fitted too: ``trial`` queries are searched exactly over
all rows, and the number is the least that covers ``coverage`` of what they found. Lists
and the queries that visit them are cut into blocks of ``block`` rows, so no list, however
common its vectors, is one task.

Vectors that are null, zero, of another length than most, or hold a null or non-finite
component take no part. Equal vectors have equal scores, so of each group of copies only
the ``k + 1`` smallest ids can be among anyone's ``k`` nearest; the others are left out
before the search without changing a result. Rows that repeat an id and vector count once.
An empty table has no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.llm.registry import query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

_FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    values = F.col("vector")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(
        F.col("id").isNotNull()
        & (F.size(values) > 0)
        & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(values, lambda x: x != 0)
    )
    common = rows.groupBy(F.size(values).alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return rows.filter(F.size(values) == (common["n"] if common else 0))


def few_copies(rows: DataFrame, most: int) -> DataFrame:
    """Of every group of equal vectors the ``most`` smallest ids, each once."""
    order = Window.partitionBy("vector").orderBy("id")
    return rows.distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= most).drop("_n")


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


@dataclass
class Codes:
    """The rotation and the lists' centres."""

    centres: np.ndarray
    rotation: np.ndarray

    def lists_of(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest centre of every vector."""
        near = vectors @ self.centres.T - 0.5 * (self.centres**2).sum(axis=1)
        return near.argmax(axis=1)

    def encode(self, vectors: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed signs, residual lengths, and inner products of residual and code."""
        residual = vectors - self.centres[lists]
        length = np.linalg.norm(residual, axis=1)
        turned = residual @ self.rotation.T
        dims = vectors.shape[1]
        # A residual of zero is estimated without error whatever its code.
        own = np.where(length > 0, np.abs(turned).sum(axis=1) / np.sqrt(dims) / np.maximum(length, 1e-300), 1.0)
        return np.packbits(turned > 0, axis=1), length, own

    def estimate(
        self, queries: np.ndarray, code: np.ndarray, length: np.ndarray, own: np.ndarray, at: int, width: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products of queries with a list's codes, and their error bounds."""
        dims = queries.shape[1]
        signs = (2.0 * np.unpackbits(code, axis=1, count=dims) - 1).astype(np.float32)
        turned = (queries @ self.rotation.T).astype(np.float32)
        inner = (turned @ signs.T) * (length / own / np.sqrt(dims)).astype(np.float32)
        spread = np.sqrt(np.maximum(0, 1 - own**2)) / own * length * width / np.sqrt(max(1, dims - 1))
        size = np.linalg.norm(queries, axis=1)
        return inner + (queries @ self.centres[at])[:, None], size[:, None] * spread[None, :] + 1e-6 * size[:, None]


def fit_codes(rows: DataFrame, count: int, sample: int, lists: int | None, rounds: int = 8) -> Codes:
    """Centres by a few rounds of k-means over a bounded hash sample, and a rotation."""
    draw = F.pmod(F.xxhash64("id", F.lit("centres")), F.lit(1_000_000)) / 1_000_000
    drawn = rows.filter(draw < F.lit(min(1.0, sample / max(1, count)))).toPandas().sort_values("id")
    points = matrix(drawn["vector"]) if len(drawn) else matrix(rows.limit(1).toPandas()["vector"])
    wanted = lists or int(np.clip(np.sqrt(count) / 8, 1, 4096))
    random = np.random.default_rng(3)
    centres = points[random.permutation(len(points))[: min(wanted, len(points))]]
    for _ in range(rounds):
        near = Codes(centres, np.eye(1)).lists_of(points)
        held = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    dims = points.shape[1]
    return Codes(centres, np.linalg.qr(random.normal(size=(dims, dims)))[0])


def exact_top(query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` largest inner products; equal vectors score equally."""
    scores = (vectors * query).sum(axis=1)
    best = np.lexsort((ids, -scores))[:k]
    return ids[best], scores[best]


def top_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def visited_lists(rows: DataFrame, queries: DataFrame, codes: Codes, k: int, trial: int, coverage: float) -> int:
    """How many lists cover ``coverage`` of the exact neighbours of ``trial`` queries."""
    tried = queries.orderBy(F.xxhash64("id", F.lit("trial")), "id").limit(trial).toPandas()
    asked, own = matrix(tried["vector"]), tried["id"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors, ids = matrix(batch["vector"]), batch["id"].to_numpy()
            near = dict(zip(ids.tolist(), codes.lists_of(vectors).tolist(), strict=True))
            for q, i in zip(asked, own, strict=True):
                other = ids != i
                best, scores = exact_top(q, vectors[other], ids[other], k)
                yield pd.DataFrame(
                    {"query_id": i, "vec_id": best, "score": scores, "list": [near[b] for b in best.tolist()]}
                )

    found = top_k(rows.mapInPandas(run, _FOUND + ", list int"), k).toPandas()
    if found.empty:
        return 1
    order = np.argsort(-(asked @ codes.centres.T), axis=1, kind="stable")
    rank = {int(i): np.argsort(o) for i, o in zip(own, order, strict=True)}
    needed = np.sort([rank[i][at] + 1 for i, at in zip(found["query_id"], found["list"], strict=True)])
    return int(needed[min(len(needed) - 1, int(np.ceil(coverage * len(needed))) - 1)])


def nearest_by_codes(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    sample: int = 20_000,
    lists: int | None = None,
    trial: int = 64,
    coverage: float = 0.97,
    block: int = 4096,
    width: float = 2.5,
) -> DataFrame:
    """The ``k`` rows of largest inner product for every row that ``queries`` selects.

    ``queries`` is a condition on the column ``id``. ``width`` is the error bound in
    standard deviations of the estimate. Result: query_id, rank, vec_id, score.
    """
    session = vectors.sparkSession
    taking_part = usable(vectors, key, vector)
    asked = stored(taking_part.filter(queries).distinct(), "queries")
    rows = stored(few_copies(taking_part, k + 1), "vectors")
    count = rows.count()
    if not count or asked.isEmpty():
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = fit_codes(rows, count, sample, lists)
    visits = visited_lists(rows, asked, codes, k, trial, coverage)
    # Bounded by the numbers of lists and dimensions.
    model = shared(session, codes)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = matrix(batch["vector"])
            near = model().lists_of(values)
            code, length, own = model().encode(values, near)
            yield batch.assign(
                list=near.astype(np.int32), code=[c.tobytes() for c in code], length=length, own=own
            )

    indexed = stored(
        rows.mapInPandas(index, "id long, vector array<double>, list int, code binary, length double, own double"),
        "codes",
    )

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at : at + 1000]
                order = np.argsort(-(matrix(part["vector"]) @ model().centres.T), axis=1, kind="stable")
                yield part.assign(list=order[:, :visits].astype(np.int32).tolist())

    visiting = asked.mapInPandas(visit, "id long, vector array<double>, list array<int>").select(
        "id", "vector", F.explode("list").alias("list")
    )
    # One row per list, of which there are at most 4096 or what the caller asks for.
    shape = F.broadcast(
        indexed.groupBy("list")
        .agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
        .join(
            visiting.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("query_blocks")), "list"
        )
    )

    def spread(own: str, other: str) -> tuple[Column, Column]:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        return mine, F.explode(F.sequence(F.lit(0), F.col(other) - 1))

    mine, each = spread("blocks", "query_blocks")
    held = indexed.join(shape, "list").select(
        "list", mine.alias("block"), each.alias("query_block"), "id", "vector", "code", "length", "own"
    )
    mine, each = spread("query_blocks", "blocks")
    coming = visiting.join(shape, "list").select(
        "list", each.alias("block"), mine.alias("query_block"), "id", "vector"
    )

    def search(key: tuple, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if here.empty or there.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        here = here.sort_values("id")
        values, ids = matrix(here["vector"]), here["id"].to_numpy()
        code = np.frombuffer(b"".join(here["code"]), np.uint8).reshape(len(here), -1)
        length, own = here["length"].to_numpy(), here["own"].to_numpy()
        out = []
        for at in range(0, len(there), 256):
            part = there.iloc[at : at + 256]
            asked, who = matrix(part["vector"]), part["id"].to_numpy()
            middle, error = model().estimate(asked, code, length, own, int(key[0]), width)
            itself = who[:, None] == ids[None, :]
            lower = np.where(itself, -np.inf, middle - error)
            upper = np.where(itself, -np.inf, middle + error)
            if len(ids) > k:
                floor = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
            else:
                floor = np.full(len(who), -np.inf)
            chosen = (upper >= floor[:, None]) & ~itself
            for i in range(len(who)):
                pick = np.flatnonzero(chosen[i])
                best, scores = exact_top(asked[i], values[pick], ids[pick], k)
                out.append((np.full(len(best), who[i]), best, scores))
        return pd.DataFrame(
            {
                "query_id": np.concatenate([o[0] for o in out]),
                "vec_id": np.concatenate([o[1] for o in out]),
                "score": np.concatenate([o[2] for o in out]),
            }
        )

    by = ("list", "block", "query_block")
    found = held.groupBy(*by).cogroup(coming.groupBy(*by)).applyInPandas(search, _FOUND)
    return top_k(found, k).select("query_id", "rank", "vec_id", "score")


@query("op10_one_bit_codes")
def op10_one_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, among all other rows."""
    return nearest_by_codes(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)
