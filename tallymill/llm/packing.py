"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window.

The inverted index is sharded. Documents are ordered by the smallest hash among their
longer words, so texts that share vocabulary tend to be neighbours, and the order is cut
into ranges and each range into shards of a fixed number of documents. A shard has an
index of its own: no posting list spans shards, a shard's memory is bounded, and a lost
executor costs only its own ranges.

Inside a shard a window begins with a seed document. The index ranks the documents that
are still unused by BM25 against the seed's heaviest terms, and the window takes them in
that order: whole ones first, and the best of the rest is cut where the window ends. What
is left of a cut document is the next seed, so every window but a range's last is full.

Null texts count as empty, an empty text is its end marker alone, rows that repeat are
packed as often as they come, ties go to the document that comes first in the order, and
an empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.chunks import encoder
from tallymill.llm.registry import query, table

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def vocabulary_files() -> tuple[str, str, str]:
    """The byte-level vocabulary of 50,257 ids: its two files and its pattern."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


class ShardIndex:
    """BM25 over the token ids of one shard's documents."""

    def __init__(self, documents: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        found = [np.unique(ids, return_counts=True) for ids in documents]
        self.ends = np.cumsum([0, *(len(t) for t, _ in found)])
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        times = np.concatenate([c for _, c in found]).astype(np.float64)
        owners = np.repeat(np.arange(len(found)), np.diff(self.ends))
        lengths = np.array([len(ids) for ids in documents], np.float64)
        self.terms, holding = np.unique(terms, return_counts=True)
        place = np.searchsorted(self.terms, terms)
        idf = np.log(1 + (len(found) - holding + 0.5) / (holding + 0.5))
        norm = k1 * (1 - b + b * lengths / max(lengths.mean(), 1))
        weights = idf[place] * times * (k1 + 1) / (times + norm[owners])
        order = np.argsort(place, kind="stable")
        self.starts = np.concatenate([[0], np.cumsum(holding)])
        self.postings, self.post_weights = owners[order], weights[order]
        self.place, self.weights, self.size = place, weights, len(found)

    def scores(self, document: int, terms: int) -> np.ndarray:
        """BM25 of every document against the ``terms`` heaviest terms of ``document``."""
        a, b = self.ends[document], self.ends[document + 1]
        places = self.place[a:b]
        if b - a > terms:
            heavy = np.argpartition(-self.weights[a:b], terms)[:terms]
            places = np.sort(places[heavy])
        spans = [slice(self.starts[p], self.starts[p + 1]) for p in places]
        return np.bincount(
            np.concatenate([self.postings[s] for s in spans]),
            np.concatenate([self.post_weights[s] for s in spans]),
            self.size,
        )


class Packer:
    """Fills windows one after the other; ``rows`` holds the finished pieces."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence, self.filled = window, first, 0
        self.rows: list[tuple] = []

    def room(self) -> int:
        return self.window - self.filled

    def take(self, doc: int, ids: np.ndarray, start: int) -> int:
        """Put ``ids[start:]`` into the window as far as it goes; returns the new start."""
        end = min(len(ids), start + self.room())
        self.rows.append(
            (doc, start, end - start, len(ids), self.sequence, self.filled, ids[start:end].tobytes())
        )
        self.filled += end - start
        if self.filled == self.window:
            self.sequence, self.filled = self.sequence + 1, 0
        return end


def pack_shard(packer: Packer, docs: list[int], ids: list[np.ndarray], terms: int, near: int) -> None:
    """Pack one shard's documents; a window that stays open is left to the next shard."""
    index = ShardIndex(ids)
    lengths = np.array([len(x) for x in ids])
    unused = np.ones(len(ids), bool)
    left, first = len(ids), 0
    seed, start = -1, 0
    while left or seed >= 0:
        if seed < 0:
            while not unused[first]:
                first += 1
            seed, start, unused[first] = first, 0, False
            left -= 1
        current = seed
        while start < lengths[current]:
            start = packer.take(docs[current], ids[current], start)
        seed = -1
        if not packer.filled or not left:
            continue
        scores = index.scores(current, terms)
        free = np.flatnonzero(unused)
        best = free[np.argsort(-scores[free], kind="stable")[: near * 4]]
        for at in range(0, len(best), near):
            if not packer.filled:
                break
            group = best[at : at + near]
            for i in group:
                if packer.filled and unused[i] and lengths[i] <= packer.room():
                    packer.take(docs[i], ids[i], 0)
                    unused[i] = False
                    left -= 1
            rest = group[unused[group]]
            if packer.filled and len(rest):
                i = int(rest[0])
                start = packer.take(docs[i], ids[i], 0)
                unused[i] = False
                left -= 1
                if start < lengths[i]:
                    seed = i
                break


def retrieval_pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = 1024,
    shard_docs: int = 2048,
    query_terms: int = 32,
    neighbours: int = 8,
    files: tuple[str, str, str] | None = None,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: whose it is, where it begins in its document and in its sequence.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. Each
    document's ids end with ``end_id``. ``query_terms`` terms of the seed are looked up,
    and ``neighbours`` ranked documents are tried whole before one is cut.
    """
    spark = docs.sparkSession
    vocabulary = files or vocabulary_files()
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) > 6)
    placed = rows.withColumn(
        "route", F.coalesce(F.array_min(F.transform(long_words, lambda w: F.xxhash64(w))), F.lit(0))
    ).withColumn("spread", F.xxhash64("doc_id"))
    count = rows.count()
    ranges = min(
        -(-count // (2 * shard_docs)),
        max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // (32 * shard_docs))),
    )
    # The id's hash parts a group of copies that is too large for one range.
    order = ("route", "spread", "doc_id", "text")
    placed = placed.repartitionByRange(max(1, ranges), *order[:3]).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(*vocabulary)
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        waiting_docs: list[int] = []
        waiting_ids: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            pack_shard(packer, waiting_docs, waiting_ids, query_terms, neighbours)
            out = pd.DataFrame(packer.rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            packer.rows, waiting_docs[:], waiting_ids[:] = [], [], []
            return out

        for batch in batches:
            for doc, content in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                waiting_docs.append(doc)
                waiting_ids.append(np.append(encode.ids(content), np.uint32(end_id)))
                if len(waiting_docs) == shard_docs:
                    yield flush()
        if waiting_docs:
            yield flush()

    return placed.select("doc_id", "text").mapInPandas(run, PIECES)


@query("op2_retrieval_packing")
def op2_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces, with a checksum of their ids."""
    pieces = retrieval_pack(table(spark, folder, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
