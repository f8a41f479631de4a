"""Packing, token attribution and sharding against brute force."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm.catalog import QUERIES
from tallymill.llm.chunks import Encoder
from tallymill.llm.packing import ShardIndex, retrieval_pack, vocabulary_files
from tallymill.llm.sharding import shard_by_bytes, write_shards
from tallymill.llm.token_counts import allocate, attribute_tokens
from tests.llm.helpers import empty_docs, odd_docs, prose, rows


@pytest.fixture(scope="module")
def encoder():
    return Encoder(*vocabulary_files())


def check_pieces(pieces, documents, encoder, window):
    """Each id of each document (with its end) lies in one piece, sequences have no gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc, texts in documents.items():
        want = Counter()
        for text in texts:
            want.update(enumerate([*encoder.exact(text or ""), 0]))
        got = Counter()
        for p in by_doc[doc]:
            ids = np.frombuffer(p["ids"], "<u4").tolist()
            assert len(ids) == p["length"] and p["doc_tokens"] == len(encoder.exact(texts[0] or "")) + 1
            got.update(enumerate(ids, p["start"]))
        assert got == want
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    return sum(window - sum(n for _, n in parts) for parts in by_sequence.values())


def test_pieces_of_odd_texts(spark, encoder):
    extra = [(100 + i, prose(i, 5 + 37 * i % 300)) for i in range(60)]
    docs = odd_docs(spark, extra)
    documents = defaultdict(list)
    for r in docs.collect():
        documents[r["doc_id"]].append(r["text"])
    pieces = rows(retrieval_pack(docs, window=128, shard_docs=16))
    padding = check_pieces(pieces, documents, encoder, 128)
    assert padding < 128 * 8
    assert rows(retrieval_pack(empty_docs(spark))) == []


def test_neighbour_shares_words():
    a, b, c = np.arange(50), np.arange(25, 75), np.arange(100, 150)
    index = ShardIndex([a, b, c])
    scores = index.scores(0, 64)
    assert scores[0] > scores[1] > scores[2] == 0


def test_query_on_the_small_table(spark, small, encoder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = rows(QUERIES["op2_retrieval_packing"](spark, small))
    assert sum(p["length"] for p in found) == sum(len(encoder.exact(t)) + 1 for t in docs.values())
    for p in found[:50]:
        ids = [*encoder.exact(docs[p["doc_id"]]), 0][p["start"] : p["start"] + p["length"]]
        assert zlib.crc32(np.asarray(ids, "<u4").tobytes()) == p["ids_crc32"]


@pytest.mark.parametrize("rule", ["first", "majority", "share"])
def test_tokens_of_sections(spark, encoder, rule):
    texts = [(20, "a\n\n\n  b c\ndéjà vu\n"), (21, "\n"), (22, "x" * 50 + "\n" + prose(3, 40))]
    docs = odd_docs(spark, texts)
    found = defaultdict(list)
    for r in rows(attribute_tokens(docs.filter("doc_id is not null").distinct(), rule=rule)):
        found[r["doc_id"]].append(r)
    for r in docs.filter("doc_id is not null").collect():
        text = r["text"] or ""
        got = sorted(found[r["doc_id"]], key=lambda s: s["section"])
        assert len(got) == len(text.split("\n"))
        assert sum(s["n_tokens"] for s in got) == pytest.approx(len(encoder.exact(text)))
        if rule == "first":
            starts = [a for a, _ in encoder._exact.encode(text, add_special_tokens=False).offsets]
            for s in got:
                assert s["n_tokens"] == sum(s["start_char"] <= a < s["end_char"] for a in starts)
    assert rows(attribute_tokens(empty_docs(spark))) == []


def test_fields_are_counted_apart(spark):
    got = rows(attribute_tokens(odd_docs(spark).filter("doc_id = 4"), fields=("text", "lang"), by_line=False))
    assert {r["field"]: r["n_tokens"] for r in got} == {"text": 2.0, "lang": 1.0}


def test_rules_on_a_crossing_token():
    starts, ends, edges = np.array([0, 3]), np.array([3, 8]), np.array([0, 4, 8])
    assert allocate(starts, ends, edges, "first").tolist() == [2, 0]
    assert allocate(starts, ends, edges, "majority").tolist() == [1, 1]
    assert allocate(starts, ends, edges, "share").tolist() == [1.2, 0.8]


def dealt(df, key="doc_id"):
    got = rows(df)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got


def test_shards_are_even_and_keep_groups(spark, tmp_path):
    docs = [(i, (i * 7919) % 500 + 8, i // 3) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, size long, text_crc32 long")
    df = df.withColumn("text_crc32", F.crc32(F.col("text_crc32").cast("string").cast("binary")))
    shards = shard_by_bytes(df, "doc_id", "text_crc32", "size", 6)
    got = dealt(shards)
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    totals, groups = Counter(), defaultdict(set)
    for r in got:
        totals[r["shard"]] += r["size"]
        groups[r["text_crc32"]].add(r["shard"])
    assert max(totals.values()) < 1.05 * min(totals.values())
    assert all(len(g) == 1 for g in groups.values())
    write_shards(shards, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 3000


def test_a_group_and_a_row_that_overfill_shards(spark):
    rows_in = [(i, 10, 5) for i in range(1000)] + [(7, 10, 9)] * 1000 + [(None, None, None)] * 2
    df = spark.createDataFrame(rows_in, "doc_id long, size long, text_crc32 long")
    got = dealt(shard_by_bytes(df, "doc_id", "text_crc32", "size", 4))
    assert len(got) == 2002
    totals = Counter()
    for r in got:
        totals[r["shard"]] += r["size"]
    assert max(totals.values()) - min(totals.values()) <= 20
    assert rows(shard_by_bytes(df.limit(0), "doc_id", "text_crc32", "size", 4)) == []


def test_op3_covers_every_document(spark, small):
    got = dealt(QUERIES["op3_sampled_splitters"](spark, small))
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]))
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 24


def test_large_groups_stay_whole_and_shards_stay_even(spark):
    """Groups from a hundredth to nearly a whole shard, and one beyond it."""
    draw = np.random.default_rng(6)
    sizes = [(g, n) for g, n in enumerate([900, 700, 500, 300, 200, 100, 60, 30, 15] * 2 + [2500])]
    data, doc = [], 0
    for g, n in sizes:
        for _ in range(n):
            data.append((doc, 100, g * 7919))
            doc += 1
    for _ in range(5000):
        data.append((doc, int(draw.integers(20, 180)), int(draw.integers(10**6, 2**32))))
        doc += 1
    df = spark.createDataFrame(data, "doc_id long, size long, text_crc32 long")
    got = dealt(shard_by_bytes(df, "doc_id", "text_crc32", "size", 8))
    assert sorted(r["doc_id"] for r in got) == list(range(doc))
    totals, groups = Counter(), defaultdict(set)
    for r in got:
        totals[r["shard"]] += r["size"]
        groups[r["text_crc32"]].add(r["shard"])
    share = sum(totals.values()) / 8
    assert all(abs(t - share) < 0.02 * share for t in totals.values())
    for g, n in sizes:
        assert (len(groups[g * 7919]) == 1) == (100 * n <= share)


def test_op3_texts_stay_together(spark, small):
    """Null and empty texts are one group, as are the copies of any text."""
    got = dealt(QUERIES["op3_sampled_splitters"](spark, small))
    groups, totals = defaultdict(set), Counter()
    for r in got:
        groups[r["text_crc32"]].add(r["shard"])
        totals[r["shard"]] += r["size"]
    share = sum(totals.values()) / 24
    held = Counter()
    for r in got:
        held[r["text_crc32"]] += r["size"]
    assert all(len(s) == 1 for g, s in groups.items() if held[g] <= share)
