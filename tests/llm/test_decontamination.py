"""Spaced seeds against brute force, and the query against its SQL."""

from __future__ import annotations

import pytest

from tallymill.llm.catalog import ORACLES, QUERIES
from tallymill.llm.decontamination import MASKS, contaminated
from tests.check_oracles import connect
from tests.llm.helpers import empty_docs, odd_docs, prose, rows


def brute(doc: list[str], item: list[str]) -> int:
    """Best run over the diagonals that a seed of either mask hits."""
    best, span = 0, len(MASKS[0])
    for diagonal in range(-len(item), len(doc)):
        places = [j for j in range(len(item)) if 0 <= diagonal + j < len(doc)]
        same = {j: doc[diagonal + j] == item[j] for j in places}
        hit = any(
            all(same.get(j + i, False) for i, bit in enumerate(m) if bit == "1")
            for m in MASKS for j in places if j + span <= len(item) and diagonal + j + span <= len(doc)
        )
        here = 0
        for j in places if hit else []:
            here = max(0, here + (1 if same[j] else -1))
            best = max(best, here)
    return best


def test_substituted_and_partial_passages(spark):
    items = {1: prose(901, 40), 2: prose(902, 12), 3: prose(903, 9), 4: "too short", 5: None, 6: prose(901, 40)}
    swapped = items[1].split()
    for i in range(6, 40, 7):
        swapped[i] = "other"
    around = prose(77, 80)
    docs = {
        100: f"{around} {items[1]} {around}",
        101: f"{around}\n{' '.join(swapped).upper()}!",
        102: " ".join(items[1].split()[10:30]),
        103: f"so: {items[2]}; {items[3]}.",
        104: around,
        105: " ".join(items[1].split()[:7]),
    }
    bench = spark.createDataFrame([(i, t, 0) for i, t in items.items()], "item_id long, text string, score int")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in rows(contaminated(odd_docs(spark, list(docs.items())), bench))}
    want = {}
    for d, text in docs.items():
        for i, item in items.items():
            a, b = ("".join(c if c.isalnum() else " " for c in (t or "").lower()).split() for t in (text, item))
            score = brute(a, b)
            if score >= max(8, min(13, -(-len(b) * 8 // 10))):
                want[d, i] = score
    assert got == want
    assert {(100, 1), (100, 6), (101, 1), (102, 1), (103, 2), (103, 3)} <= set(want)
    assert not any(d in (104, 105) for d, _ in want)
    assert rows(contaminated(empty_docs(spark), bench)) == rows(contaminated(odd_docs(spark), bench.limit(0))) == []


def test_query_equals_sql(spark, small):
    cur = connect(small).execute(ORACLES["op1_spaced_seeds"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(dict(zip(names, r)).items()) for r in cur.fetchall())
    got = QUERIES["op1_spaced_seeds"](spark, small)
    assert sorted(got.columns) == sorted(names)
    assert sorted(tuple((n, r[n]) for n in names) for r in got.collect()) == want and want


def test_masks_of_different_length_are_refused(spark):
    with pytest.raises(ValueError):
        contaminated(odd_docs(spark), odd_docs(spark).withColumnRenamed("doc_id", "item_id"), masks=("111", "1101"))
