"""Learnt operators: held-out accuracy, and the parts that have exact answers."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm.catalog import QUERIES
from tallymill.llm.language import fit_backoff, identify
from tallymill.llm.nearest import nearest_by_codes
from tallymill.llm.quality import FactorisationMachine, fit_quality, laid_out, score_quality
from tallymill.llm.toxicity import fit_label_model, fit_toxicity, score_toxicity
from tests.llm.helpers import empty_docs, odd_docs, rows

SMALL = "/root/testdata/sf0.01"


def area(labels, scores):
    """Chance that a positive scores above a negative."""
    order = np.argsort(np.argsort(scores, kind="stable"))
    labels = np.asarray(labels, bool)
    n = labels.sum()
    return (order[labels].sum() - n * (n - 1) / 2) / max(1, n * (~labels).sum())


def scored(spark, name):
    got = rows(QUERIES[name](spark, SMALL))
    count = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len(got) == count
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    return {r["doc_id"]: r for r in got}


@pytest.mark.parametrize(
    "name,label,floor", [("op4_factorisation_machine", "quality", 0.85), ("op6_weak_supervision", "toxic", 0.85)]
)
def test_held_out_ranking(spark, name, label, floor):
    got = scored(spark, name)
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    held = [i for i in labels if i in got and got[i]["held_out"]]
    assert area([labels[i] for i in held], [got[i]["score"] for i in held]) > floor
    bound = {"quality": 0.5, "toxic": 0.7}[label]
    assert all(r["predicted"] == int(r["score"] >= bound) for r in got.values())


def test_pairwise_identity():
    draw = np.random.default_rng(0)
    machine = FactorisationMachine(0.3, draw.normal(size=50), draw.normal(size=(50, 4)))
    picked = [(draw.permutation(50)[:n], draw.normal(size=n)) for n in (1, 5, 12)]
    for (index, value), got in zip(picked, machine.raw(*laid_out(picked)), strict=True):
        want = machine.bias + machine.linear[index] @ value
        for a in range(len(index)):
            for b in range(a):
                want += machine.factors[index[a]] @ machine.factors[index[b]] * value[a] * value[b]
        assert got == pytest.approx(want)


def test_label_model_ranks_and_discounts():
    draw = np.random.default_rng(2)
    truth = draw.random(8000) < 0.2
    rates = [(0.7, 0.02), (0.5, 0.05), (0.6, 0.01), (0.4, 0.03)]
    votes = np.stack([draw.random(8000) < np.where(truth, a, b) for a, b in rates], axis=1)
    votes = np.column_stack([votes, votes[:, 0], ~votes.any(axis=1)])
    model = fit_label_model(votes, np.array([False] * 5 + [True]))
    # Silence counts as abstaining, so rates are biased low; their order is right.
    assert np.argsort(model.on_toxic[[0, 3]]).tolist() == [1, 0] and model.on_toxic[:4].min() > 0.25
    # The voter that was entered twice counts about once.
    assert model.weight[0] + model.weight[4] < 1.3 and model.weight[2] > 0.6
    assert area(truth, model.posterior(votes.astype(float))) > 0.85


def test_models_on_odd_rows_and_without_labels(spark):
    docs, labels = odd_docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    machine = fit_quality(docs, labels)
    assert {r["score"] for r in rows(score_quality(docs, machine))} == {0.5}
    fitted = fit_toxicity(docs, labels)
    assert "idiot" in fitted[2]
    assert max(r["score"] for r in rows(score_toxicity(docs, *fitted))) < 0.5
    labels = spark.createDataFrame(
        [(1, 0, 0), (2, 1, None), (6, 1, 0), (6, 1, 0), (8, None, 1), (None, 1, 1), (999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    machine = fit_quality(docs, labels, metadata=("n_chars",))
    out = score_quality(docs, machine, metadata=("n_chars",))
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert len(rows(out)) == docs.count()
    fitted = fit_toxicity(docs, labels)
    assert len(rows(score_toxicity(docs, *fitted))) == docs.count()
    none = fit_toxicity(empty_docs(spark), labels)
    assert none[1] is None and max(r["score"] for r in rows(score_toxicity(docs, *none))) < 0.5
    assert rows(score_quality(empty_docs(spark), machine)) == rows(score_toxicity(empty_docs(spark), *fitted)) == []


def test_language_held_out_accuracy(spark):
    got = rows(QUERIES["op9_word_backoff"](spark, SMALL))
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(got) == len(want)
    held = [r for r in got if r["held_out"] and want[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.95


def test_backoff_of_words(spark):
    data = [(1, "the house and the tree", "en"), (2, "das haus und der baum", "de"), (3, None, "en"), (4, "unknown", None)]
    model = fit_backoff(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame(
        [(1, "the tree"), (2, "der baum"), (3, "hausbaum"), (4, None), (5, ""), (6, "12 ½ !!"), (7, "THE")],
        "doc_id long, text string",
    ).withColumn("score", F.lit("clash"))
    got = {r["doc_id"]: r for r in rows(identify(asked, model))}
    assert [got[i]["lang_pred"] for i in range(1, 8)] == ["en", "de", "de", "und", "und", "und", "en"]
    assert got[4]["score"] == 0 and got[1]["score"] > 0.5
    nothing = fit_backoff(empty_docs(spark))
    assert {r["lang_pred"] for r in rows(identify(odd_docs(spark), nothing))} == {"und"}


def test_backoff_keeps_every_word_and_gram(spark):
    """Rare words, rare languages and long runs count, however few words travel to the tasks."""
    run = "".join(chr(0x3041 + i % 80) for i in range(2500))
    data = [(i, "alpha beta gamma delta epsilon " * 50, "en") for i in range(20)]
    data += [(100, "alpha qo", "zz"), (101, "alpha beta " + "k" * 45, "de"), (102, run, "ja")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    asked = spark.createDataFrame(
        [(1, "qo"), (2, "qoqo"), (3, "k" * 45), (4, run), (5, run[1200:1260]), (6, "gamma"), (7, "1 ½"), (7, "qo qo qo")],
        "doc_id long, text string",
    )
    few, many = fit_backoff(docs, words=2), fit_backoff(docs)
    assert len(few.common) == 2
    got, whole = (sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in rows(identify(asked, m))) for m in (few, many))
    assert [r[:2] for r in got] == [
        (1, "zz"), (2, "zz"), (3, "de"), (4, "ja"), (5, "ja"), (6, "en"), (7, "und"), (7, "zz")]
    assert [r[2] for r in got] == pytest.approx([r[2] for r in whole])


def brute_nearest(vectors, queries, k):
    ids = np.array(sorted(vectors))
    table = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        scores = (table * np.array(vectors[q], np.float64)).sum(axis=1)
        keep = ids != q
        best = np.lexsort((ids[keep], -scores[keep]))[:k]
        out[q] = list(zip(ids[keep][best].tolist(), scores[keep][best].tolist(), strict=True))
    return out


def test_nearest_recall(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in table}
    want = brute_nearest(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = {}
    for r in rows(QUERIES["op10_one_bit_codes"](spark, SMALL)):
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = {(q, v): s for q, found in want.items() for v, s in found}
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        ordered = [found[i] for i in range(1, 21)]
        assert ordered == sorted(ordered, key=lambda x: (-x[1], x[0]))
        assert all(exact.get((q, v), s) == s for v, s in ordered)


def test_nearest_of_copies_and_odd_vectors(spark):
    draw = np.random.default_rng(6)
    data = [(i, draw.normal(size=8).tolist()) for i in range(200)]
    data += [(1000 + i, data[3][1]) for i in range(90)] + [(3, data[3][1])]
    odd = [(300, None), (320, []), (340, [0.0] * 8), (360, [None] + [1.0] * 7), (380, [float("nan")] * 8),
           (400, [float("inf")] * 8), (420, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    clean = {r["vec_id"]: r["embedding"] for r in df.filter("vec_id < 300 or vec_id >= 1000").collect()}
    want = brute_nearest(clean, [i for i in clean if i % 20 == 0], 20)
    got = {}
    for r in rows(nearest_by_codes(df, F.col("id") % 20 == 0, block=64, lists=4, coverage=1.0, width=6.0)):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert {q: [(v, s) for _, v, s in sorted(f)] for q, f in got.items()} == want
    few = df.filter("vec_id < 5")
    assert len(rows(nearest_by_codes(few, F.col("id") == 0))) == 4
    assert rows(nearest_by_codes(df.limit(0), F.col("id") % 20 == 0)) == []
