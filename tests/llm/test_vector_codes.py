"""Equal-average search against all distances, and codes against a plain loop."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallymill.llm.vector_codes import EqualAverage, equal_average_codes, with_label_total
from tests.llm.helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int, id string, parts int, error double"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, label, "x", 1, 2.0) for i, v, label in vectors], SCHEMA)


def brute(vectors, parts=4, entries=256, rounds=4, scale=1024):
    """Codes and errors in the order of the kept vectors, and the codebooks."""
    kept = [
        (i, v, label)
        for i, v, label in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts))
    whole = []
    for _, v, _ in kept:
        numbers = [math.floor(scale * float(np.float32(x))) for x in v] + [0] * (parts * width - len(v))
        whole.append([numbers[p * width : (p + 1) * width] for p in range(parts)])
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, whole[r]))
    books = [[whole[r][p] for r in order[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            taken = {}
            for row in whole:
                taken.setdefault(nearest(book, row[p])[1], []).append(row[p])
            books[p] = [
                [sum(c) // len(c) for c in zip(*taken[n])] if n in taken else e for n, e in enumerate(book)
            ]
    found = []
    for (i, _, label), row in zip(kept, whole, strict=True):
        best = [nearest(book, part) for book, part in zip(books, row, strict=True)]
        found.append((i, label, [n for _, n in best], sum(d for d, _ in best)))
    return found, books


@pytest.mark.parametrize("spread", [3, 40, 2000])
def test_search_equals_all_distances(spread):
    draw = np.random.default_rng(spread)
    entries = draw.integers(-spread, spread, (64, 7))
    entries[10:20] = entries[30:40]  # equal entries: the lower index wins
    points = np.concatenate([draw.integers(-spread, spread, (500, 7)), entries])
    index, distance = EqualAverage(entries)(points)
    every = ((points[:, None] - entries) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_codes_of_odd_vectors(spark):
    draw = np.random.default_rng(2)
    vectors = [(i, draw.normal(size=10).astype(np.float32).tolist(), i % 3) for i in range(60)]
    vectors += [
        (100, None, 1), (101, [1.0, None], 1), (102, [math.nan] * 10, 1), (103, [math.inf] * 10, 1),
        (104, [], 5), (105, [0.5, 0.25], None), (106, [0.0] * 10, None), (7, vectors[7][1], 9),
        (None, vectors[8][1], None), (8, vectors[9][1], 1),
    ]
    codes, books = equal_average_codes(table(spark, vectors), entries=16)
    want, want_books = brute(vectors, entries=16)

    def bag(values):
        return sorted(map(repr, values))

    assert books.tolist() == want_books
    assert bag((r["id"], r["label"], list(r["codes"]), r["error"]) for r in rows(codes)) == bag(want)


def test_labels_share_their_sum(spark):
    data = [(i, None if i % 2 else i % 5, i) for i in range(4000)] + [(9000 + i, i, 1) for i in range(1500)]
    df = spark.createDataFrame(data, "vec_id long, label int, error long")
    sums = {}
    for _, label, error in data:
        sums[label] = sums.get(label, 0) + error
    got = rows(with_label_total(df, "label", "error", "all"))
    assert len(got) == len(data) and all(r["all"] == sums[r["label"]] for r in got)


def test_no_vectors_and_too_large_ones(spark):
    codes, books = equal_average_codes(table(spark, [(1, None, 1)]))
    assert books is None and rows(codes) == []
    with pytest.raises(ValueError):
        equal_average_codes(table(spark, [(1, [1e9], 1)]))
