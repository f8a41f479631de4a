"""Vector code compression: product codes whose nearest entries come from an equal-average search.

A vector is scaled to integers and cut into consecutive parts; each part is replaced by the
number of the nearest entry of its position's codebook. With ``d`` components a part and an
entry whose component sums differ by ``g`` are at a squared distance of ``g * g / d`` at
least. So the entries of a codebook lie ordered by their sums; the search starts where the
part's own sum would stand, looks at one more entry on either side at a time, and ends on a
side as soon as ``g * g / d`` strictly exceeds the best distance, which is right for every
later entry of that side as well. Entries at the same distance are still seen, and the one
with the lower index wins.

Every round is one scan: tasks add up the parts of each entry, and only these sums, ``parts *
entries * (width + 1)`` numbers whatever the number of rows, come to the driver.

Vectors that are null or hold a null, NaN or infinite component are dropped. Shorter vectors
count as ended by zeros, as do all where the longest does not divide into equal parts.
The first codebook takes the vectors in the order of their ids, null ids last, repeated ids by
their components; with fewer vectors than entries it has as many entries as vectors. Rows
that repeat are coded each. An empty table has no codes. Components of 2**16 or more do not
fit the 64-bit sums and raise ``ValueError``. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.registry import query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

_LIMIT = 2**16
# Labels with more than this share of the rows are sent to every task: at most 1,000 of them.
_HOT = 1000


class EqualAverage:
    """Nearest entries of one codebook, found outward from a part's component sum."""

    def __init__(self, entries: np.ndarray):
        self.size, self.width = entries.shape
        total = entries.sum(axis=1)
        self.order = np.argsort(total, kind="stable")
        self.sums, self.entries = total[self.order], entries[self.order]

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of every row of ``points``, and the squared distance."""
        own = points.sum(axis=1)
        start = np.searchsorted(self.sums, own)
        best = np.full(len(points), np.iinfo(np.int64).max // max(1, self.width))
        index = np.full(len(points), self.size)
        sides = {1: np.arange(len(points)), -1: np.arange(len(points))}
        for step in range(self.size):
            for way, open_rows in sides.items():
                at = start[open_rows] + (step if way > 0 else -1 - step)
                inside = (at >= 0) & (at < self.size)
                rows, at = open_rows[inside], at[inside]
                gap = self.sums[at] - own[rows]
                near = gap * gap <= best[rows] * self.width
                rows, at = rows[near], at[near]
                apart = points[rows] - self.entries[at]
                distance = np.einsum("ij,ij->i", apart, apart)
                number = self.order[at]
                better = (distance < best[rows]) | ((distance == best[rows]) & (number < index[rows]))
                best[rows[better]], index[rows[better]] = distance[better], number[better]
                sides[way] = rows
            if not len(sides[1]) and not len(sides[-1]):
                break
        return index, best


def scaled(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, parts): the kept vectors in integers, ``floor(scale * x)``."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(vector).isNotNull() & ~bad).select(
        F.col(key).alias("id"),
        F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("parts"),
    )


def _matrix(values: pd.Series, length: int) -> np.ndarray:
    out = np.zeros((len(values), length), np.int64)
    for row, value in zip(out, values, strict=True):
        row[: len(value)] = value
    return out


def fit_codebooks(
    rows: DataFrame, parts: int, entries: int, rounds: int, scale: int
) -> np.ndarray | None:
    """Codebooks (part, entry, component) after ``rounds`` rounds, or None without any row."""
    found = rows.agg(
        F.max(F.size("parts")),
        F.max(F.coalesce(F.array_max(F.transform("parts", F.abs)), F.lit(0))),
    ).first()
    if found[0] is None:
        return None
    if found[1] >= _LIMIT * scale:
        raise ValueError(f"components of {_LIMIT} or more are out of range")
    width = max(1, -(-found[0] // parts))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "parts").limit(entries).select("parts").toPandas()
    books = np.ascontiguousarray(
        _matrix(first["parts"], parts * width).reshape(len(first), parts, width).transpose(1, 0, 2)
    )
    for _ in range(rounds):
        totals = np.zeros((parts, books.shape[1], width + 1), np.int64)
        sums = _sums(rows, books).groupBy("slot").agg(F.sum("total").alias("total")).toPandas()
        totals.reshape(-1)[sums["slot"]] = sums["total"]
        count = totals[..., -1:]
        books = np.where(count > 0, totals[..., :-1] // np.maximum(count, 1), books)
    return books


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(slot, total): per part and entry the summed components, then the number, of its parts."""
    parts, size, width = books.shape
    get = shared(rows.sparkSession, [EqualAverage(b) for b in books])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search, totals = get(), np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            points = _matrix(batch["parts"], parts * width).reshape(len(batch), parts, width)
            for p in range(parts):
                index, _ = search[p](points[:, p])
                np.add.at(totals[p], index, np.append(points[:, p], np.ones((len(batch), 1), np.int64), axis=1))
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"slot": used, "total": totals.reshape(-1)[used]})

    return rows.select("parts").mapInPandas(run, "slot long, total long")


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, codes, error) of the rows of :func:`scaled`; codes are entry numbers."""
    parts, _, width = books.shape
    get = shared(rows.sparkSession, [EqualAverage(b) for b in books])
    kind = rows.schema["label"].dataType.simpleString()
    name = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = get()
        for batch in batches:
            points = _matrix(batch["parts"], parts * width).reshape(len(batch), parts, width)
            found = [search[p](points[:, p]) for p in range(parts)]
            codes = np.stack([index for index, _ in found], axis=1)
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "label": batch["label"],
                    "codes": list(codes.astype(np.int32)),
                    "error": sum(distance for _, distance in found),
                }
            )

    return rows.mapInPandas(run, f"id {name}, label {kind}, codes array<int>, error long")


def with_label_total(rows: DataFrame, label: str, value: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over equal labels, nulls together.

    The few labels that hold a thousandth of the rows or more are sent to the rows; the
    rows of the others meet their sums in a shuffle, in which no label is large.
    """
    totals = stored(
        rows.groupBy(F.col(label).alias("_l")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("_n")),
        "label-totals",
    )
    count = totals.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(totals.filter(F.col("_n") * _HOT >= count))
    same = F.col(label).eqNullSafe(F.col("_l"))
    often = rows.join(hot, same)
    seldom = rows.join(hot, same, "left_anti").join(totals.filter(F.col("_n") * _HOT < count), same)
    return often.unionByName(seldom).drop("_l", "_n")


def equal_average_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all kept vectors (id, label, codes, error), and the codebooks behind them."""
    rows = scaled(vectors, key, vector, label, scale)
    books = fit_codebooks(rows, parts, entries, rounds, scale)
    if books is None:
        empty = rows.select("id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"))
        return empty.filter(F.lit(False)), None
    return encode(rows, books), books


_ROUND = """
seen{k} AS (
    SELECT r, p, any_value(v) AS v, min(struct_pack(d := xx - 2 * list_dot_product(v, c) + cc, e := e)) AS best
    FROM parts JOIN (SELECT p, e, c, list_dot_product(c, c) AS cc FROM book{k}) USING (p) GROUP BY r, p),
sums{k} AS (
    SELECT p, e, i, floor(sum(x) / count(*)) AS x
    FROM (SELECT p, best.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM seen{k}) GROUP BY p, e, i),
book{n} AS (
    SELECT p, e, coalesce(n.c, o.c) AS c FROM book{k} o
    LEFT JOIN (SELECT p, e, list(x ORDER BY i) AS c FROM sums{k} GROUP BY p, e) n USING (p, e)),"""

# Integers of this size are exact as doubles.
_SQL = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024.0 * CAST(x AS DOUBLE))) AS v,
        row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
    SELECT r, p, v, list_dot_product(v, v) AS xx FROM (
        SELECT r, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS v FROM kept, range(4) AS t(p))),
book0 AS (SELECT p, r AS e, v AS c FROM parts WHERE r < 256),
{"".join(_ROUND.format(k=k, n=k + 1) for k in range(4))}
last AS (
    SELECT r, p, min(struct_pack(d := xx - 2 * list_dot_product(v, c) + cc, e := e)) AS best
    FROM parts JOIN (SELECT p, e, c, list_dot_product(c, c) AS cc FROM book4) USING (p) GROUP BY r, p),
digest AS (
    SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM book4)),
coded AS (
    SELECT r, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code,
        CAST(sum(best.d) AS BIGINT) AS error
    FROM last GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (r), digest
"""


@query("op11_equal_average", _SQL)
def op11_equal_average(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings, their errors, and a digest of the codebooks."""
    codes, books = equal_average_codes(table(spark, folder, "embeddings"))
    digits = F.concat_ws("", F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))
    coded = codes.select(F.col("id").alias("vec_id"), "label", digits.alias("code"), "error")
    numbers = "" if books is None else ",".join(map(str, books.reshape(-1).tolist()))
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return with_label_total(stored(coded, "vector-codes"), "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
