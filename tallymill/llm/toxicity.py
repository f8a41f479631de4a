"""Toxicity by weak supervision.

1. Voters. A short list of insults, the words and word beginnings that mark toxic texts in a
   bounded sample of labelled rows (all that qualify; of words that begin alike the shortest
   common beginning votes for all), and patterns: at most one word voted for, which votes
   against, two of them, more, one next to a person, and shouting.
2. Label model. All learnable documents vote, and equal votes are counted together. A
   latent-class model is fitted to these counts by expectation maximisation: how often each
   voter fires on either class, hence its accuracy. The correlation of two voters is what
   their votes still have in common within a class; a voter's weight is divided by the number
   of voters that it repeats. Every round is one pass over the counts; only a number per
   voter, and the pairs of voters that are alike, come to the driver.
3. Classifier. A linear model over hashed words, word beginnings, fired voters and the label
   model's evidence is trained on its labels (the likelier class) of a bounded sample of learnable documents,
   labelled or not, and scores every text whole.

A null text scores like an empty one, and very long texts are read whole. Rows that repeat
vote each, but are drawn once; equal scores stay equal. Without labelled rows the voters are
the written list and the patterns; without any row every score is near 0.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.features import hashed, labelled_sample, sigmoid, words_of
from tallymill.llm.quality import learnable
from tallymill.llm.registry import held_out, query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

#: Insults every model starts from.
INSULTS = (
    "bastard", "clown", "creep", "crap", "degenerate", "disgusting", "dumb", "dumbass",
    "failure", "fool", "garbage", "idiot", "imbecile", "jerk", "liar", "loser", "moron",
    "pathetic", "pig", "retard", "scum", "shut", "stupid", "trash", "ugly", "useless",
    "vermin", "weirdo", "worthless",
)
_PEOPLE = frozenset(("you", "your", "they", "he", "she", "du", "tu", "vous", "ihr"))
_SHOUT = re.compile(r"\b[A-Z]{4,}\b.*!!")
BUCKETS = 1 << 17
_BEGINNINGS = (3, 4, 5, 6, 7)
PATTERNS = ("pattern few", "pattern two", "pattern more", "pattern person", "pattern shout")
# Tells a whole word from a beginning.
_WHOLE = 0x5BD1E995


def forms_of(word: str) -> list[str]:
    """A word, and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in _BEGINNINGS if len(word) > n)]


def word_buckets(words: set[str]) -> np.ndarray:
    """The distinct feature buckets of words and of their first four and six bytes.

    One checksum runs through a word; its value after four and six bytes is that of the
    beginning.
    """
    found = set()
    for word in words:
        raw = word.encode("utf-8", "surrogatepass")
        first = zlib.crc32(raw[:4], 1)
        second = zlib.crc32(raw[4:6], first)
        found.add(zlib.crc32(raw[6:], second ^ _WHOLE) % BUCKETS)
        if len(raw) > 4:
            found.add(first % BUCKETS)
        if len(raw) > 6:
            found.add(second % BUCKETS)
    return np.sort(np.fromiter(found, np.int64, len(found)))


class Voters:
    """What fires on a text: the numbers of ``terms``, then those of the patterns.

    A word is looked at closely only if some voter begins like it.
    """

    def __init__(self, terms: list[str]):
        self.terms = sorted(terms)
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.width = len(self.terms) + len(PATTERNS)
        self._starts = {t[: _BEGINNINGS[0]] for t in self.terms}

    def __contains__(self, term: str) -> bool:
        return term in self.number

    def of_word(self, word: str) -> list[int]:
        """The voters of a word."""
        if word[: _BEGINNINGS[0]] not in self._starts:
            return []
        return [self.number[t] for t in forms_of(word) if t in self.number]

    def fired(self, text: str | None, words: list[str] | None = None) -> list[int]:
        words = words_of(text or "") if words is None else words
        hits = {w: v for w in set(words) if (v := self.of_word(w))}
        out = sorted(set().union(*hits.values()))
        patterns = len(self.terms)
        out.append(patterns + max(0, min(len(hits), 3) - 1))
        if hits and any(
            w in hits and (i and words[i - 1] in _PEOPLE or words[i + 1 : i + 2] and words[i + 1] in _PEOPLE)
            for i, w in enumerate(words)
        ):
            out.append(patterns + 3)
        if "!!" in (text or "") and _SHOUT.search(text):
            out.append(patterns + 4)
        return out

    def against(self) -> np.ndarray:
        """The voters that speak for a clean text."""
        out = np.zeros(self.width, bool)
        out[len(self.terms)] = True
        return out

    def counting(self) -> np.ndarray:
        """The patterns: what they say hangs on the other voters, but repeats none."""
        return np.arange(self.width) >= len(self.terms)

    def features(self, text: str | None, model: LabelModel) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values: fired voters count 1 each, all terms together 1, then the evidence."""
        words = words_of(text or "")
        fired = self.fired(text, words)
        terms = word_buckets(set(words))
        names = np.sort(hashed([f"vote {i}" for i in fired], BUCKETS))
        evidence = float(np.clip(model.log_odds(fired), -10, 10)) / 4
        index = np.concatenate([names, terms, [BUCKETS + 1]])
        values = np.concatenate(
            [np.ones(len(names)), np.full(len(terms), 1 / np.sqrt(max(1, len(terms)))), [evidence]]
        )
        return index.astype("<i4"), values.astype("<f4")


@dataclass
class LabelModel:
    """Firing rates of each voter on either class, and its share of independent evidence."""

    share: float
    on_toxic: np.ndarray
    on_clean: np.ndarray
    weight: np.ndarray

    def evidence(self) -> np.ndarray:
        """What a fired voter adds to the log odds; a voter that stays silent abstains."""
        return np.log(self.on_toxic / self.on_clean) * self.weight

    def prior(self) -> float:
        return float(np.log(self.share / (1 - self.share)))

    def log_odds(self, fired: list[int]) -> float:
        return self.prior() + float(self.evidence()[fired].sum())

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return sigmoid(self.prior() + votes @ self.evidence())

    def accuracy(self) -> np.ndarray:
        """The chance that a voter that fires is right to call a text toxic."""
        hit = self.share * self.on_toxic
        return hit / (hit + (1 - self.share) * self.on_clean)


def expectation_maximisation(
    expected: Callable[[float, np.ndarray], tuple[float, np.ndarray]],
    rows: float,
    fired: np.ndarray,
    together: tuple[np.ndarray, np.ndarray, np.ndarray],
    against: np.ndarray,
    counting: np.ndarray,
    rounds: int = 12,
) -> LabelModel:
    """The label model of votes that are only reached through sums.

    ``expected(prior, evidence)`` gives the expected number of toxic texts, in all and per
    fired voter. ``fired`` counts each voter, ``together`` (i, j, count) pairs that are alike.
    Voters of ``counting`` tell how many others fired; they repeat none of them.
    """
    first, second, both = together

    def discount(toxic: float, on_toxic: np.ndarray, on_clean: np.ndarray, least: float) -> np.ndarray:
        """One over the number of voters that each repeats within the classes, itself included."""

        def left(i, j, count):
            return count - toxic * on_toxic[i] * on_toxic[j] - (rows - toxic) * on_clean[i] * on_clean[j]

        every = np.arange(len(fired))
        scale = np.sqrt(np.maximum(left(every, every, fired), 1e-9))
        alike = np.abs(left(first, second, both)) / (scale[first] * scale[second])
        alike = np.where((alike > least) & ~counting[first] & ~counting[second], np.minimum(alike, 1), 0)
        return 1 / (1 + np.bincount(first, alike, len(fired)) + np.bincount(second, alike, len(fired)))

    rate = fired / max(rows, 1e-9)
    # Before the classes are known only voters that are nearly the same are discounted, and
    # the first guess is what most voters say: some voter for, and none against.
    weight = discount(0.0, rate, rate, 0.7)
    toxic, sums = expected(-1.0, np.where(against, -10.0, 3.2))
    model = LabelModel(0.1, np.full(len(fired), 0.5), np.full(len(fired), 0.5), weight)
    for at in range(rounds):
        clean = rows - toxic
        on_toxic, on_clean = (sums + 0.1) / (toxic + 1), (fired - sums + 0.1) / (clean + 1)
        if at in (rounds // 3, 2 * rounds // 3):
            weight = discount(toxic, on_toxic, on_clean, 0.2)
        model = LabelModel(float(np.clip(toxic / max(rows, 1e-9), 0.01, 0.5)), on_toxic, on_clean, weight)
        toxic, sums = expected(model.prior(), model.evidence())
    return model


def fit_label_model(votes: np.ndarray, against: np.ndarray, counting: np.ndarray | None = None) -> LabelModel:
    """The label model of a matrix of votes."""
    counting = against if counting is None else counting
    votes = votes.astype(float)

    def expected(prior: float, evidence: np.ndarray) -> tuple[float, np.ndarray]:
        belief = sigmoid(prior + votes @ evidence)
        return belief.sum(), belief @ votes

    together = votes.T @ votes
    first, second = np.triu_indices(votes.shape[1], 1)
    return expectation_maximisation(
        expected, len(votes), np.diag(together).copy(), (first, second, together[first, second]), against, counting
    )


def _vote_counts(docs: DataFrame, voters: Voters) -> DataFrame:
    """(votes, n): every set of votes with the number of texts that cast it."""
    get = shared(docs.sparkSession, voters)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = get()
        for batch in batches:
            counts = Counter(tuple(known.fired(t)) for t in batch["text"])
            yield pd.DataFrame({"votes": [list(v) for v in counts], "n": list(counts.values())})

    return docs.select("text").mapInPandas(run, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n"))


def _fit_counted(counts: DataFrame, voters: Voters, alike: float = 0.2) -> LabelModel:
    """The label model of the vote counts of a whole corpus."""

    def expected(prior: float, evidence: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals = np.zeros(len(evidence) + 1)
            for batch in batches:
                owner = np.repeat(np.arange(len(batch)), batch["votes"].map(len))
                fired = np.concatenate(batch["votes"].to_list()).astype(int)
                belief = sigmoid(prior + np.bincount(owner, evidence[fired], len(batch)))
                toxic = belief * batch["n"].to_numpy()
                totals[:-1] += np.bincount(fired, toxic[owner], len(evidence))
                totals[-1] += toxic.sum()
            used = np.flatnonzero(totals)
            yield pd.DataFrame({"slot": used, "total": totals[used]})

        sums = np.zeros(len(evidence) + 1)
        found = counts.mapInPandas(run, "slot int, total double").groupBy("slot").agg(F.sum("total").alias("total"))
        found = found.toPandas()
        sums[found["slot"]] = found["total"]
        return sums[-1], sums[:-1]

    one = counts.select(F.explode("votes").alias("i"), "n").groupBy("i").agg(F.sum("n").alias("n"))
    own = one.toPandas()
    fired = np.zeros(voters.width)
    fired[own["i"]] = own["n"]
    # Pairs below this share of their voters cannot be alike, whatever the classes are.
    pair = counts.select(F.explode("votes").alias("i"), "votes", "n").select(
        "i", F.explode(F.filter("votes", lambda j: j > F.col("i"))).alias("j"), "n"
    )
    pair = pair.groupBy("i", "j").agg(F.sum("n").alias("both"))
    for side in ("i", "j"):
        pair = pair.join(one.select(F.col("i").alias(side), F.col("n").alias(f"n_{side}")), side)
    pair = pair.filter(F.col("both") >= alike / 2 * F.sqrt(F.col("n_i").cast("double") * F.col("n_j"))).toPandas()
    rows = counts.agg(F.sum("n")).first()[0]
    together = tuple(pair[c].to_numpy() for c in ("i", "j", "both"))
    return expectation_maximisation(expected, rows, fired, together, voters.against(), voters.counting())


def fit_linear(
    rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 12, rate: float = 0.3
) -> np.ndarray:
    """Weights by feature bucket, then the bias and that of the evidence; logistic loss."""
    weights, seen = np.zeros(BUCKETS + 2), np.full(BUCKETS + 2, 1e-2)
    if not len(rows):
        weights[BUCKETS] = -40.0
        return weights
    weights[BUCKETS] = -2.0
    random = np.random.default_rng(11)
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 64):
            chosen = order[at : at + 64]
            index = np.concatenate([np.append(rows[i][0], BUCKETS) for i in chosen])
            value = np.concatenate([np.append(rows[i][1], 1.0) for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) + 1 for i in chosen])
            error = sigmoid(np.bincount(owner, weights[index] * value, len(chosen))) - target[chosen]
            touched, place = np.unique(index, return_inverse=True)
            step = np.bincount(place, error[owner] * value, len(touched)) / len(chosen) + 1e-5 * weights[touched]
            seen[touched] += step * step
            weights[touched] -= rate * step / np.sqrt(seen[touched])
    return weights


def find_voters(sample: DataFrame, text: str, precision: float = 0.9, chance: float = 50.0) -> list[str]:
    """The written insults, and every term that marks labelled toxic rows.

    A term qualifies if the share ``precision`` of its rows is toxic, give or take half a
    row, and if of all terms no more than about ``chance`` would look as good by accident.
    One that begins with another such term is left out, as it would repeat its votes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                rows = [
                    (t, n)
                    for c, n in zip(part["text"], part["_label"], strict=True)
                    for t in sorted({f for w in set(words_of(c or "")) for f in forms_of(w)})
                ]
                yield pd.DataFrame(rows, columns=["term", "label"])

    whole = sample.agg(F.count(F.lit(1)), F.sum("_label")).first()
    if not whole[1] or whole[1] == whole[0]:
        return sorted(INSULTS)
    base = whole[1] / whole[0]
    counts = stored(
        sample.select(F.col(text).alias("text"), "_label")
        .mapInPandas(run, "term string, label int")
        .groupBy("term")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")),
        "term-labels",
    )
    need = math.log(max(1, counts.count()) / chance)
    share, clean = F.col("toxic") / F.col("all"), F.col("all") - F.col("toxic")
    surprise = F.col("toxic") * F.log(share / base) + F.when(
        clean > 0, clean * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    good = counts.filter((F.col("toxic") > 0) & (F.col("toxic") + 0.5 >= precision * F.col("all")))
    # The sample is bounded, and so are its terms.
    found = {r["term"] for r in good.filter(surprise >= need).select("term").collect()}
    return sorted({*INSULTS, *(t for t in found if found.isdisjoint(f for f in forms_of(t.rstrip("-"))[1:] if f != t))})


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", rows: int = 12_000
) -> tuple[np.ndarray, LabelModel | None, Voters]:
    """The classifier's weights, the label model of all ``docs``, and its voters.

    Voters are found in, and the classifier is fitted to, about ``rows`` rows at most.
    """
    docs = docs.select("doc_id", F.col(text).alias("text"))
    voters = Voters(find_voters(labelled_sample(docs, labels, label, rows), "text"))
    counts = stored(_vote_counts(docs, voters), "vote-counts")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return fit_linear([], np.zeros(0)), None, voters
    model = _fit_counted(counts, voters)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("learn")), F.lit(1_000_000)) / 1_000_000
    sample = docs.filter(draw < F.lit(min(1.0, rows / total))).dropDuplicates(["doc_id", "text"])
    get = shared(docs.sparkSession, (voters, model))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, labels = get()
        for batch in batches:
            found = [known.features(t, labels) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "belief": [float(labels.log_odds(known.fired(t)) > 0) for t in batch["text"]],
                    "index": [i.tobytes() for i, _ in found],
                    "value": [v.tobytes() for _, v in found],
                }
            )

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = pd.concat([*batches, pd.DataFrame({"belief": [], "index": [], "value": []})])
        found = found.sort_values(["index", "belief"], kind="stable")
        parsed = [
            (np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4"))
            for i, v in zip(found["index"], found["value"], strict=True)
        ]
        yield pd.DataFrame({"model": [pickle.dumps(fit_linear(parsed, found["belief"].to_numpy(float)))]})

    found = sample.mapInPandas(features, "belief double, index binary, value binary")
    row = found.repartition(1).mapInPandas(fit, "model binary").first()
    return pickle.loads(row["model"]), model, voters


def score_toxicity(
    docs: DataFrame,
    weights: np.ndarray,
    model: LabelModel | None,
    voters: Voters,
    text: str = "text",
    score: str = "score",
) -> DataFrame:
    """``docs`` with a score from 0 to 1, higher for toxic; it replaces a column of that name."""
    # Its size is fixed by the numbers of buckets and voters.
    width = voters.width
    model = model or LabelModel(0.01, np.full(width, 0.5), np.full(width, 0.5), np.ones(width))
    get = shared(docs.sparkSession, (weights, model, voters))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            w, labels, known = get()
            found = (known.features(t, labels) for t in batch)
            raw = [float(w[i] @ v + w[BUCKETS]) for i, v in found]
            yield pd.Series(sigmoid(np.array(raw, float)))

    kept = [c for c in docs.columns if c != score]
    return docs.select(*kept, F.pandas_udf(run, "double")(F.col(text)).alias(score))


@query("op6_weak_supervision")
def op6_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; learnt from labelled rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fitted = fit_toxicity(learnable(docs), table(spark, folder, "labels"))
    return score_toxicity(docs, *fitted).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
