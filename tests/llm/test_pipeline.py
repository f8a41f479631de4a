"""The pipeline's stages on the smallest tables and on odd documents."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tallymill.llm.packing import PIECES
from tallymill.session import stored
from tests.llm.helpers import empty_docs, odd_docs, prose, rows
from tests.llm.test_near_duplicates import brute

STAGES = dict(corpus_pipeline.STAGES)


def test_stages_follow_each_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, small), "test-stage")
        assert after.dtypes == docs.dtypes
        counts.append(after.count())
        if name == "near_dedup":
            groups = brute({r["doc_id"]: r["text"] for r in docs.collect()})
            want = {i for i, (_, component) in groups.items() if i == component}
            assert {r["doc_id"] for r in after.collect()} == want
        if name == "personal_data":
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            changed = [r for r in after.collect() if r["text"] != before[r["doc_id"]]]
            assert changed and all(r["n_chars"] == len(r["text"]) for r in changed)
        docs = after
    assert counts == sorted(counts, reverse=True) and counts[1] > 0.7 * counts[0]
    packed = rows(STAGES["packing"](spark, docs, small))
    assert {p["doc_id"] for p in packed} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_and_empty_documents(spark, small, name):
    docs = odd_docs(spark, [(50 + i, prose(50 + i, 80)) for i in range(5)])
    for given in (docs, empty_docs(spark)):
        out = STAGES[name](spark, given, small)
        if name == "packing":
            assert out.columns == [c.split()[0] for c in PIECES.split(", ")]
        else:
            assert out.columns == given.columns
        out.collect()
    if name == "near_dedup":
        kept = [r["doc_id"] for r in STAGES[name](spark, docs, small).collect()]
        assert kept.count(5) == 1 and kept.count(None) == 1 and 6 in kept and 7 not in kept
