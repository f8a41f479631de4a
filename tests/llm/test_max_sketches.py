"""Ranked search against scoring every document, with small sketches so that bounds collide."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from tallymill.llm import max_sketches
from tallymill.llm.max_sketches import ranked_search, terms_of
from tests.llm.helpers import WORDS, empty_docs, odd_docs, prose, rows


def plain_terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=10):
    held = [(d, Counter(t), len(t)) for d, t in ((d, plain_terms(t)) for d, t in docs) if t]
    n, total = len(held), sum(x for _, _, x in held)
    out = []
    for item, text in set(items):
        scored = []
        for doc, counts, length in held:
            score = 0
            for t in set(plain_terms(text)):
                df = sum(t in c for _, c, _ in held)
                tf = counts[t]
                if df:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * length * n) // total)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:k], 1):
            out.append((repr(item), rank, None if null else doc, -score))
    return sorted(out, key=repr)


def found(df):
    return sorted(((repr(r["item"]), r["rank"], r["doc"], r["score"]) for r in rows(df)), key=repr)


@pytest.mark.parametrize("coordinates,block", [(4096, 400_000), (7, 400_000), (64, 20)])
def test_equals_scoring_everything(spark, monkeypatch, coordinates, block):
    monkeypatch.setattr(max_sketches, "_BLOCK", block)
    monkeypatch.setattr(max_sketches, "_BATCH", 16)
    extra = [(100 + i, prose(i, 5 + 7 * (i % 9))) for i in range(150)]
    extra += [(400 + i, prose(3, 30)) for i in range(30)]  # ties beyond the first ten
    extra += [(2**60 + i, "Unusual TERM " + prose(i, 3)) for i in range(12)]
    docs = odd_docs(spark, extra)
    items = [
        (1, prose(3, 30)), (2, "unusual, term! " + WORDS[0]), (3, None), (4, "nowhere-found"), (5, ""),
        (1, "ALDER ünï 日本語"), (2, "unusual, term! " + WORDS[0]), (None, "maple maple oak"),
    ]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id int, text string, doc_id int, rank string")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert found(ranked_search(docs, asked, coordinates=coordinates)) == want


def test_empty_tables(spark):
    docs = odd_docs(spark)
    asked = spark.createDataFrame([(1, "one tie")], "item_id int, text string")
    assert rows(ranked_search(empty_docs(spark), asked)) == []
    assert rows(ranked_search(docs, asked.limit(0))) == []
    assert [r["doc"] for r in rows(ranked_search(docs, asked))][:2] == [4, 5]


@pytest.mark.parametrize("text", ["A-b_c9 É\x7fx\x00y", "日本、語   z", "", None, "[a]{b}"])
def test_terms(text):
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)
