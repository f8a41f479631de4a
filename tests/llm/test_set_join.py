"""The set join against all pairs of sets, with the heavy paths forced."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from tallymill.llm import clusters, set_join
from tallymill.llm.clusters import link_clusters, links
from tallymill.llm.set_join import boundary_of, heavy_light_join
from tests.llm.helpers import empty_docs, odd_docs, prose, rows
from tests.llm.test_near_duplicates import edited, shingles


def brute(texts: list[tuple[int | None, str | None]], percent: int) -> list[tuple]:
    """(id, size, least id reachable) of every row."""
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            parent[root(b)] = root(a)
    ids = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            ids[root(i)] = min(doc, ids.get(root(i), doc))
    return sorted((repr(d), len(s), repr(ids.get(root(i)))) for i, ((d, _), s) in enumerate(zip(texts, sets, strict=True)))


def corpus(spark, extra=()):
    out = list(extra)
    for seed, size, count in ((1, 12, 12), (2, 40, 30), (3, 150, 40), (4, 700, 12)):
        source = prose(50 + seed, size)
        out += [(1000 * seed + i, edited(source, i, i % (2 + size // 25))) for i in range(count)]
    passage = prose(70, 60)
    out += [(9000 + i, f"{prose(300 + i, 30)} {passage} {prose(400 + i, 30)}") for i in range(40)]
    out += [(9500 + i, f"{passage} {prose(500 + i, 1 + i % 5)}") for i in range(30)]
    return odd_docs(spark, out)


def found(df):
    return sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in rows(df))


@pytest.mark.parametrize("percent", [80, 60])
def test_equals_all_pairs(spark, percent):
    docs = corpus(spark)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], percent)
    assert found(heavy_light_join(docs, percent=percent)) == want


@pytest.mark.parametrize("boundary,least", [(0, 2), (200, 2), (60, 1000)])
def test_any_boundary_and_any_heavy_count_give_the_same(spark, monkeypatch, boundary, least):
    """All sets small, all large, or mixed; nearly all elements heavy, or none; cut clusters."""
    monkeypatch.setattr(set_join, "boundary_of", lambda *_: boundary)
    monkeypatch.setattr(set_join, "_LEAST_HEAVY", least)
    monkeypatch.setattr(clusters, "_BLOCK_BYTES", 6000)
    docs = corpus(spark, [(5, "other text under a known id"), (None, prose(6, 60))])
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 80)
    assert found(heavy_light_join(docs)) == want


def test_empty_table(spark):
    assert rows(heavy_light_join(empty_docs(spark))) == []


def test_boundary_follows_the_cost():
    sizes = {n: 10 for n in range(4, 400)}
    cheap, dear = boundary_of(sizes, 80, 1.0), boundary_of(sizes, 80, 30.0)
    assert 0 < cheap < dear <= 200


def test_links_join_parts_and_no_more():
    draw = np.random.default_rng(3)
    base = np.sort(draw.choice(10**6, 60, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(40):
        own = base.copy()
        own[draw.choice(60, 4, replace=False)] = draw.integers(10**7, 10**9, 4)
        sets.append(np.sort(own))
    near = {(i, j) for i, j in combinations(range(40), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    got = links(sets, 80)
    assert {tuple(sorted(p)) for p in got} <= near

    def parts(pairs):
        of = list(range(40))
        for a, b in pairs:
            of = [of[a] if x == of[b] else x for x in of]
        return len(set(of))

    assert parts(got) == parts(near) and len(got) == 40 - parts(near)


def test_a_group_just_below_the_threshold_makes_no_rows(spark):
    """Hundreds of members, none linked: no pair becomes a row."""
    draw = np.random.default_rng(4)
    data = []
    for i in range(300):
        own = np.concatenate([np.arange(100), draw.integers(10**6, 10**9, 14)]).astype(np.uint64)
        data.append((1, i, bytearray(np.sort(own).tobytes())))
    members = spark.createDataFrame(data, "cluster long, node long, payload binary")
    got = link_clusters(members, lambda: lambda b: np.frombuffer(b, np.uint64), 80)
    assert got.count() == 0
    linked = link_clusters(members, lambda: lambda b: np.frombuffer(b, np.uint64), 75)
    assert linked.count() == 299
