"""Ranked lexical search with hashed max-sketches.

The impact of a term in a document is what the ranking formula gives for it before the term's
weight. A document's sketch holds, for each of ``coordinates`` hash values, the largest
impact of its terms there. Looking up the terms of a query adds up, weight by weight, to an
upper bound of the document's score, and one matrix product gives the bounds of a batch of
documents for all queries. Each query then rescores documents exactly in descending order of
their bounds and stops when the next bound is below the score of its worst kept document;
a bound that equals it is still rescored, as the smaller id wins a tie.

Two scans: the first counts documents, terms and, for the terms of the queries only, the
documents that hold them; the second sketches, bounds and rescores where the text is, so no
text is shuffled. Every task returns its best ``k`` documents of a query, and two steps of
windows merge them. Queries are sent to the tasks in blocks of bounded size.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, A to Z lowered. Null
and empty texts have none; such documents are not counted, such items find nothing. Very long
texts are read whole. Repeated documents are found each. Items that repeat with the same text
are one item; the same id with other texts is ranked for each of them. Equal scores go by
ascending id, null ids last. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.llm.registry import query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_LOWERED = bytes(range(256)).lower()
_TERMS = bytes(c if c in _KEPT else 0x20 for c in _LOWERED)
# (item, term) pairs in a block of queries, and documents in a matrix of sketches.
_BLOCK = 400_000
_BATCH = 512


def terms_of(text: str | None) -> list[bytes]:
    """The terms of ``text`` in UTF-8, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impact(count, length: int, documents: int, terms: int):
    """A term that occurs ``count`` times among ``length`` (below 1,000,000)."""
    return (1_000_000_000 * count) // (1000 * count + 8 * (10 + 90 * length * documents // terms))


class Queries:
    """The distinct terms of a block of items, with their weights once these are known."""

    def __init__(self, terms: list[list[bytes]], coordinates: int):
        self.terms, self.coordinates = terms, coordinates
        self.known = {t: i for i, t in enumerate(sorted(set().union(*terms)))}

    def weigh(self, documents: int, total: int, holding: np.ndarray) -> None:
        """Take in the numbers of documents, of terms, and of documents per known term."""
        self.documents, self.total = documents, total
        weights = {t: weight(documents, int(holding[i])) for t, i in self.known.items()}
        self.weights = [[(t, weights[t]) for t in terms] for terms in self.terms]
        places = {t: zlib.crc32(t) % self.coordinates for t in self.known}
        self.used = np.array(sorted(set(places.values())), np.int64)
        row = {c: i for i, c in enumerate(self.used.tolist())}
        self.lookup = np.zeros((len(self.used), len(self.terms)))
        for q, pairs in enumerate(self.weights):
            for term, w in pairs:
                self.lookup[row[places[term]], q] += w

    def sketch(self, counts: Counter, length: int) -> np.ndarray:
        """The coordinates that any query looks up, each with its largest impact."""
        found = np.zeros(self.coordinates)
        places = np.fromiter((zlib.crc32(t) for t in counts), np.int64, len(counts)) % self.coordinates
        values = np.fromiter(counts.values(), np.int64, len(counts))
        np.maximum.at(found, places, impact(values, length, self.documents, self.total))
        return found[self.used]

    def score(self, q: int, counts: Counter, length: int) -> int:
        return sum(
            w * impact(counts[t], length, self.documents, self.total) for t, w in self.weights[q] if t in counts
        )


def _holding(docs: DataFrame, get) -> DataFrame:
    """(slot, total): 0 documents with terms, 1 all terms, 2 + i documents that hold term i."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = get().known
        totals = np.zeros(2 + len(known), np.int64)
        for batch in batches:
            for text in batch["text"]:
                terms = terms_of(text)
                if terms:
                    totals[0] += 1
                    totals[1] += len(terms)
                    totals[[2 + known[t] for t in known.keys() & set(terms)]] += 1
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"slot": used, "total": totals[used]})

    return docs.select("text").mapInPandas(run, "slot long, total long")


def _best(docs: DataFrame, get, k: int) -> DataFrame:
    """(item, doc, score): each task's best ``k`` documents of every item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries: Queries = get()
        best: list[list[tuple]] = [[] for _ in queries.terms]
        least = np.ones(len(best))
        for batch in batches:
            for at in range(0, len(batch), _BATCH):
                part = batch.iloc[at : at + _BATCH]
                held = []
                for doc, text in zip(part["doc"], part["text"], strict=True):
                    terms = terms_of(text)
                    if terms:
                        held.append((None if doc is None else int(doc), Counter(terms), len(terms)))
                if not held:
                    continue
                bounds = np.stack([queries.sketch(c, n) for _, c, n in held]) @ queries.lookup
                for q in np.flatnonzero((bounds >= least).any(axis=0)).tolist():
                    kept, column = best[q], bounds[:, q]
                    for row in np.argsort(-column, kind="stable").tolist():
                        if column[row] < least[q]:
                            break
                        doc, counts, length = held[row]
                        score = queries.score(q, counts, length)
                        if score > 0:
                            insort(kept, (-score, doc is None, doc or 0))
                            del kept[k:]
                            if len(kept) == k:
                                least[q] = -kept[-1][0]
        found = [(q, None if null else doc, -score) for q, kept in enumerate(best) for score, null, doc in kept]
        frame = pd.DataFrame(found, columns=["item", "doc", "score"])
        yield frame.assign(doc=pd.array([doc for _, doc, _ in found], dtype="Int64"))

    return docs.mapInPandas(run, "item long, doc long, score long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item with their ``rank``; slices of an item come first."""
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc", "score"), F.lit(64))
    sliced = found.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    )
    return (
        sliced.filter(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
        .filter(F.col("rank") <= k)
        .drop("part")
    )


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    coordinates: int = 4096,
) -> DataFrame:
    """(item, rank, doc, score): the ``k`` best documents, with a score above 0, of every item."""
    spark = docs.sparkSession
    # Ids travel as text: pandas would turn a column with nulls into floating point.
    rows = docs.select(F.col(key).cast("long").cast("string").alias("doc"), F.col(text).alias("text"))
    kind = items.schema[item].dataType.simpleString()

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"name": batch["name"], "terms": [sorted(set(terms_of(t))) for t in batch["text"]]})

    asked = stored(
        items.select(F.col(item).alias("name"), F.col(item_text).alias("text"))
        .distinct()
        .mapInPandas(split, f"name {kind}, terms array<binary>"),
        "search-items",
    )
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // _BLOCK)
    results = [spark.createDataFrame([], f"item {kind}, rank int, doc long, score long")]
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("name", F.to_json(F.struct("terms"))), F.lit(blocks)) == block)
        own = own.filter(F.size("terms") > 0).collect()
        queries = Queries([[bytes(t) for t in r["terms"]] for r in own], coordinates)
        if not own:
            continue
        totals = np.zeros(2 + len(queries.known), np.int64)
        counted = _holding(rows, shared(spark, queries)).groupBy("slot").agg(F.sum("total").alias("total")).toPandas()
        totals[counted["slot"]] = counted["total"]
        if not totals[0]:
            continue
        queries.weigh(int(totals[0]), int(totals[1]), totals[2:])
        names = spark.createDataFrame(
            [(i, r["name"]) for i, r in enumerate(own)], f"number long, name {kind}"
        )
        found = _merged(_best(rows, shared(spark, queries), k), k)
        results.append(
            found.join(F.broadcast(names), found["item"] == names["number"]).select(
                F.col("name").alias("item"), "rank", "doc", "score"
            )
        )
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents WHERE text IS NOT NULL),
counted AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM counted GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
size AS (SELECT count(*) AS all_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM docs WHERE len(terms) > 0),
asked AS (
    SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
scored AS (
    SELECT item_id, text, r, doc_id, CAST(sum(
        CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN df USING (term), size GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (
        PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""


@query("op13_max_sketches", _SQL)
def op13_max_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
