"""Near duplicates against brute force over all pairs of shingle sets."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from tallymill.llm.catalog import QUERIES
from tallymill.llm.near_duplicates import Shingler, Signer, connect, least_matches, near_duplicates
from tests.llm.helpers import empty_docs, odd_docs, prose, rows


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) by union of all linked pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in texts}


def edited(text, seed, changes):
    words, draw = text.split(), random.Random(seed)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def check(df, texts):
    want = brute(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(df)}
    assert got == want


def test_groups_of_copies_chains_and_odd_texts(spark):
    source = [prose(50, 120), prose(51, 200), prose(52, 6)]
    extra = [(100 + i, edited(source[0], i, i % 5)) for i in range(60)]
    extra += [(200 + i, edited(source[1], i, 6 + i % 6)) for i in range(60)]
    text = prose(53, 150)
    for i in range(12):  # a chain whose ends are not linked
        extra.append((300 + i, text))
        text = edited(text, i, 3)
    extra += [(400, source[2]), (401, source[2].upper()), (402, source[2] + "\n")]
    docs = odd_docs(spark, extra)
    texts = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null").collect()}
    found = near_duplicates(docs)
    assert found.count() == docs.count()
    check(found.filter("doc_id is not null").distinct(), texts)
    assert rows(near_duplicates(empty_docs(spark))) == []


def test_shared_passage_does_not_link(spark):
    passage = prose(60, 60)
    texts = {i: f"{prose(600 + i, 50)} {passage} {prose(700 + i, 60)}" for i in range(80)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(near_duplicates(df), texts)


def test_query_equals_brute_force(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = rows(QUERIES["op7_bayesian_minhash"](spark, small))
    want = brute(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_signatures_estimate_similarity():
    shingler, signer = Shingler(5), Signer(2000)
    a, b = (shingler(t) for t in (prose(1, 300), edited(prose(1, 300), 4, 10)))
    exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signer(a) == signer(b)).mean() - exact) < 0.05


def test_pruning_keeps_pairs_at_the_threshold():
    draw = np.random.default_rng(1)
    plan = least_matches(225, 25, 0.75, 1e-6)
    same = np.cumsum(draw.random((20000, 225)) < 0.75, axis=1)
    assert all((same[:, n - 1] >= m).all() for n, m in plan)
    assert plan[0][1] > 5 and plan[-1][1] > 120


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in rows(connect(spark.createDataFrame(pairs, "a long, b long"), "t"))}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 40)}


@pytest.mark.parametrize("text,size", [("a b c", 1), ("a b c d e f", 2), ("x x x x x x x", 1), ("", 0)])
def test_set_sizes(text, size):
    assert len(Shingler(5)(text)) == size == len(shingles(text))
