"""A factorisation machine for text quality.

The score of a text is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` over hashed
words, binned structure statistics and binned numeric metadata. The pairwise term is
evaluated in linear time as half the difference between the square of the sum and the sum
of the squares of ``v_i x_i``, summed over the factors.

The model is fitted on a bounded sample of labelled rows (``rows``); every text is scored
whole. A null text scores like an empty one, which has structure features only. With no
labelled row the score is 0.5 for every text. Very long texts are read whole, rows that
repeat are scored each, equal texts with equal metadata have equal scores, an empty table has
no rows, and a column named like the score is replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.features import hashed, labelled_sample, sigmoid, structure
from tallymill.llm.registry import held_out, query, table
from tallymill.llm.sharing import shared

WORD_BUCKETS, STRUCTURE_BUCKETS = 1 << 15, 1 << 12
_SIZE = WORD_BUCKETS + STRUCTURE_BUCKETS


def encode_row(text: str | None, metadata: dict[str, float | None]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values. Words share one unit of weight, each statistic has one."""
    text = text or ""
    words = hashed(set(text.lower().split()), WORD_BUCKETS)
    bins = [f"{name} {round(value)}" for name, value in structure(text).items()]
    for name, value in metadata.items():
        known = value is not None and np.isfinite(value) and value > -1
        bins.append(f"meta {name} {round(float(np.log2(1 + value))) if known else 'none'}")
    built = WORD_BUCKETS + hashed(bins, STRUCTURE_BUCKETS)
    weights = [np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(len(built))]
    return np.concatenate([words, built]), np.concatenate(weights)


@dataclass
class FactorisationMachine:
    """``raw`` takes rows laid end to end: feature numbers, values and where each row begins."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        held = self.factors[index] * value[:, None]
        summed = np.add.reduceat(held, starts)
        squares = np.add.reduceat((held * held).sum(axis=1), starts)
        first = np.add.reduceat(self.linear[index] * value, starts)
        return self.bias + first + 0.5 * ((summed * summed).sum(axis=1) - squares)


def laid_out(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every row has its structure features, so none is empty."""
    ends = np.cumsum([len(i) for i, _ in rows])
    return (
        np.concatenate([i for i, _ in rows]),
        np.concatenate([v for _, v in rows]),
        np.concatenate([[0], ends[:-1]]),
    )


def fit_machine(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    factors: int = 8,
    epochs: int = 12,
    rate: float = 0.1,
    decay: float = 1e-4,
    batch: int = 128,
) -> FactorisationMachine:
    """Logistic loss by adaptive gradient steps over mini-batches in a fixed order."""
    random = np.random.default_rng(7)
    machine = FactorisationMachine(0.0, np.zeros(_SIZE), random.normal(0, 0.02, (_SIZE, factors)))
    if not len(labels):
        machine.factors[:] = 0
        return machine
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    machine.bias = float(np.log(share / (1 - share)))
    linear_seen, factor_seen = np.full(_SIZE, 1e-2), np.full((_SIZE, factors), 1e-2)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            index, value, starts = laid_out([rows[i] for i in chosen])
            error = sigmoid(machine.raw(index, value, starts)) - labels[chosen]
            owner = np.repeat(np.arange(len(chosen)), np.diff([*starts, len(index)]))
            touched, place = np.unique(index, return_inverse=True)
            held = machine.factors[index] * value[:, None]
            summed = np.add.reduceat(held, starts)
            slope = error[owner] * value / len(chosen)
            step = np.bincount(place, slope, len(touched)) + decay * machine.linear[touched]
            linear_seen[touched] += step * step
            machine.linear[touched] -= rate * step / np.sqrt(linear_seen[touched])
            pair = slope[:, None] * (summed[owner] - held)
            for f in range(factors):
                step = np.bincount(place, pair[:, f], len(touched)) + decay * machine.factors[touched, f]
                factor_seen[touched, f] += step * step
                machine.factors[touched, f] -= 0.3 * rate * step / np.sqrt(factor_seen[touched, f])
            machine.bias -= 0.05 * float(error.mean())
    return machine


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text: str = "text",
    metadata: tuple[str, ...] = (),
    rows: int = 12_000,
) -> FactorisationMachine:
    """Fit on at most about ``rows`` labelled rows; one task holds their features."""
    sample = labelled_sample(docs, labels, label, rows)
    picked = sample.select(
        "doc_id", F.col(text).alias("text"), "_label", *(F.col(m).cast("double").alias(f"m_{m}") for m in metadata)
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            meta = batch[[f"m_{m}" for m in metadata]].to_dict("records") or [{}] * len(batch)
            found = [encode_row(t, m) for t, m in zip(batch["text"], meta, strict=True)]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "label": batch["_label"],
                    "index": [i.astype("<i4").tobytes() for i, _ in found],
                    "value": [v.astype("<f4").tobytes() for _, v in found],
                }
            )

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_rows = pd.concat([*batches, pd.DataFrame({"doc_id": [], "label": [], "index": [], "value": []})])
        all_rows = all_rows.sort_values(["doc_id", "index"], kind="stable")
        parsed = [
            (np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4").astype(float))
            for i, v in zip(all_rows["index"], all_rows["value"], strict=True)
        ]
        machine = fit_machine(parsed, all_rows["label"].to_numpy(float))
        yield pd.DataFrame({"model": [pickle.dumps((machine.bias, machine.linear, machine.factors))]})

    found = picked.mapInPandas(features, "doc_id long, label int, index binary, value binary")
    model = found.repartition(1).mapInPandas(fit, "model binary").first()
    return FactorisationMachine(*pickle.loads(model["model"])) if model else fit_machine([], np.zeros(0))


def score_quality(
    docs: DataFrame,
    machine: FactorisationMachine,
    text: str = "text",
    metadata: tuple[str, ...] = (),
    score: str = "score",
) -> DataFrame:
    """``docs`` with a score from 0 to 1, higher for better; it replaces a column of that name."""
    # Its size is fixed by the numbers of buckets and factors.
    model = shared(docs.sparkSession, machine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                meta = part[list(metadata)].to_dict("records") or [{}] * len(part)
                found = [encode_row(t, m) for t, m in zip(part["text"], meta, strict=True)]
                out.append(sigmoid(model().raw(*laid_out(found))))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    packed = F.struct(F.col(text).alias("text"), *(F.col(m).cast("double").alias(m) for m in metadata))
    kept = [c for c in docs.columns if c != score]
    return docs.select(*kept, F.pandas_udf(run, "double")(packed).alias(score))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(F.col("doc_id")))


@query("op4_factorisation_machine")
def op4_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; learnt from labelled rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    machine = fit_quality(learnable(docs), table(spark, folder, "labels"), metadata=("n_chars",))
    scored = score_quality(docs, machine, metadata=("n_chars",))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
