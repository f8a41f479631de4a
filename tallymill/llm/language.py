"""Language identification: known words first, shorter and shorter n-grams after.

Word counts per language are taken over all learnable documents. A word that was counted
adds its log frequency in each language. An unseen word falls back to its counted n-grams
of the longest order that has any (their mean log frequency), down to single letters.
Every counted word and n-gram belongs to the model, whatever its length or frequency. The
most frequent ``words`` words travel to the tasks; all others, and the n-grams, stay
written tables to which the remaining words of the documents are joined.

A null text and a text without a letter give ``und`` with score 0. Ties go to the
language that sorts first. Without any learnable document every prediction is ``und``.
Rows that repeat count, and are predicted, as often as they come; very long texts are read
whole; an empty table has no rows; a column named like a result is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.registry import held_out, query, table
from tallymill.llm.sharing import shared
from tallymill.session import stored

_WORD = re.compile(r"[^\W\d_]+")
#: Distinct words, and letters of text, after which a task hands on its counts.
_FLUSH, _FLUSH_LETTERS = 200_000, 50_000_000
#: A long run is cut into its n-grams by blocks of so many letters.
_BLOCK = 1000
#: Log frequencies are added as whole multiples of 1 / _UNIT, so their order is of no account.
_UNIT = 1 << 30


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def count_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """How often each language has each word: (lang, word, n)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        letters = 0

        def emit() -> pd.DataFrame:
            rows = [(name, w, n) for name, c in seen.items() for w, n in c.items()]
            seen.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for batch in batches:
            for name, content in zip(batch["lang"], batch["text"], strict=True):
                counter = seen.get(name)
                if counter is None:
                    counter = seen[name] = Counter()
                counter.update(words_of(content))
                letters += len(content)
                if letters > _FLUSH_LETTERS:
                    letters = 0
                    yield emit()
            if sum(map(len, seen.values())) > _FLUSH:
                letters = 0
                yield emit()
        if seen:
            yield emit()

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    return rows.mapInPandas(run, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")
    )


def with_grams(rows: DataFrame, orders: tuple[int, ...], *kept: str) -> DataFrame:
    """The n-grams of every ``term`` as ``gram``, one row per place, beside the columns ``kept``."""
    longest = max(orders)
    blocks = rows.select(
        *kept,
        F.concat(F.lit("<"), F.col("term"), F.lit(">")).alias("_marked"),
        F.explode(F.sequence(F.lit(0), F.length("term") + 1, F.lit(_BLOCK))).alias("_from"),
    ).select(
        *kept,
        F.substring("_marked", F.col("_from") + 1, F.lit(_BLOCK + longest - 1)).alias("_body"),
        (F.length("_marked") - F.col("_from")).alias("_left"),
    )

    def pieces(n: int):
        places = F.least(F.lit(_BLOCK), F.col("_left") - (n - 1))
        cut = F.transform(F.sequence(F.lit(1), places), lambda i: F.substring(F.col("_body"), i, F.lit(n)))
        return F.when(places >= 1, cut if n > 1 else F.filter(cut, lambda g: ~g.isin("<", ">"))).otherwise(F.array())

    return blocks.select(*kept, F.explode(F.flatten(F.array(*map(pieces, orders)))).alias("gram"))


@dataclass
class BackoffModel:
    """Log frequencies per language of words and of n-grams.

    ``words`` and ``grams`` hold all of them as (term, gains): what each language that has
    the term gains over one that does not, whose log frequency is in ``word_floor`` and
    ``gram_floor``. ``common`` numbers the rows of ``scores``, which has the most frequent
    words once more, whole.
    """

    langs: list[str]
    orders: tuple[int, ...]
    words: DataFrame
    grams: DataFrame
    word_floor: np.ndarray
    gram_floor: np.ndarray
    common: dict[str, int]
    scores: np.ndarray


def fit_backoff(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    words: int = 60_000,
    orders: tuple[int, ...] = (5, 4, 3, 2, 1),
) -> BackoffModel:
    """Count all of ``docs``; the most frequent ``words`` words are those sent to tasks."""
    counts = stored(count_words(docs, text, lang), "language-words").withColumnRenamed("word", "term")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    numbers = F.create_map(*(F.lit(x) for i, name in enumerate(langs) for x in (name, i)))
    number = numbers[F.col("lang")] if langs else F.lit(0)
    gain = F.round(F.log((F.col("n") + 0.1) / 0.1) * _UNIT).cast("long")

    def gains(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("term").agg(
            F.sum("n").alias("n"), F.collect_list(F.struct(number.alias("lang"), gain.alias("gain"))).alias("gains")
        )

    gram_counts = with_grams(counts, orders, "lang", "n").groupBy("lang", F.col("gram").alias("term"))
    all_words = stored(gains(counts), "language-model-words")
    all_grams = stored(gains(gram_counts.agg(F.sum("n").alias("n"))), "language-model-grams")

    def floor(distinct: int) -> np.ndarray:
        return np.log(0.1 / (np.array([totals[x] for x in langs], float) + 0.1 * distinct + 1))

    word_floor, gram_floor = floor(all_words.count()), floor(all_grams.count())
    top = all_words.orderBy(F.desc("n"), "term").limit(words).collect()
    scores = np.tile(word_floor, (len(top), 1))
    for i, row in enumerate(top):
        for found in row["gains"]:
            scores[i, found["lang"]] += found["gain"] / _UNIT
    common = {row["term"]: i for i, row in enumerate(top)}
    return BackoffModel(langs, orders, all_words, all_grams, word_floor, gram_floor, common, scores)


def unseen_gains(terms: DataFrame, model: BackoffModel) -> DataFrame:
    """(term, gains) of words that were not counted: the mean over their n-grams.

    Those of the longest order that has any are taken; words without any are left out.
    """
    parts = []
    for order in model.orders:
        grams = model.grams.filter(F.length("term") == order).select(F.col("term").alias("gram"), "gains")
        places = F.array(F.struct(F.lit(-1).alias("lang"), F.lit(1).cast("long").alias("gain")))
        sums = (
            with_grams(terms, (order,), "term")
            .join(grams, "gram")
            .select("term", F.inline(F.concat("gains", places)))
            .groupBy("term", "lang")
            .agg(F.sum("gain").alias("gain"))
            .groupBy("term")
            .agg(
                F.max(F.when(F.col("lang") < 0, F.col("gain"))).alias("places"),
                F.collect_list(F.when(F.col("lang") >= 0, F.struct("lang", "gain"))).alias("sums"),
            )
        )
        mean = F.transform(
            "sums", lambda x: F.struct(x["lang"].alias("lang"), F.round(x["gain"] / F.col("places")).cast("long").alias("gain"))
        )
        parts.append(stored(sums.select("term", mean.alias("gains")), "unseen-words"))
        if order == model.orders[-1]:
            break
        terms = stored(terms.join(parts[-1], "term", "left_anti"), "unseen-left")
        if terms.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts)


def identify(
    docs: DataFrame, model: BackoffModel, text: str = "text", kept: tuple[str, ...] | None = None
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); both replace columns of that name.

    ``kept`` names the columns to return, all by default.
    """
    names = [c for c in (docs.columns if kept is None else kept) if c not in ("lang_pred", "score")]
    spark = docs.sparkSession
    langs, word_floor, gram_floor = model.langs, model.word_floor, model.gram_floor
    if not langs:
        return docs.select(*names, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # Bounded by the parameter ``words``.
    sent = shared(spark, (model.common, model.scores))

    def read(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        common, scores = sent()
        for batch in texts:
            out = []
            for content in batch:
                found = words_of(content)
                if not any(c.isalpha() for w in found for c in w):
                    found = []
                counted = Counter(found)
                rows = [(common[w], n) for w, n in counted.items() if w in common]
                rest = [(w, n) for w, n in counted.items() if w not in common]
                total = np.zeros(len(langs))
                if rows:
                    places, times = np.array(rows).T
                    total = times @ scores[places]
                out.append((len(found), total.tolist(), [w for w, _ in rest], [n for _, n in rest]))
            yield pd.DataFrame(out, columns=["n", "total", "words", "times"])

    schema = "n long, total array<double>, words array<string>, times array<long>"
    found = F.pandas_udf(read, schema)(F.col(text))
    # Written with a number of its own per row, so that rows with the same text stay apart.
    row = F.struct(*names) if names else F.struct(F.lit(0))
    start = docs.select(row.alias("_row"), found.alias("_found"), F.monotonically_increasing_id().alias("_id"))
    start = stored(start.select("_id", "_row", "_found.*"), "language-rows")
    rest = start.select("_id", F.inline(F.arrays_zip("words", "times"))).withColumnsRenamed({"words": "term", "times": "n"})
    terms = stored(
        rest.select("term").distinct().join(model.words.select("term", "gains"), "term", "left"), "language-terms"
    )
    unseen = unseen_gains(terms.filter("gains is null").select("term"), model)
    # A word counts once under -1 if it was seen, under -2 if its n-grams were.
    every = terms.filter("gains is not null").withColumn("kind", F.lit(-1)).unionByName(
        unseen.withColumn("kind", F.lit(-2))
    )
    kind = F.array(F.struct(F.col("kind").alias("lang"), F.lit(1).cast("long").alias("gain")))
    # Words sent to tasks are not among these, so no term has more than a small share of the rows.
    sums = (
        rest.join(every.select("term", F.concat("gains", kind).alias("gains")), "term")
        .select("_id", "n", F.inline("gains"))
        .groupBy("_id", "lang")
        .agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        .groupBy("_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("lang", "gain"))).alias("gains"))
    )

    def gain_of(i: int):
        return F.coalesce(F.col("gains")[F.lit(i)], F.lit(0)).alias(f"g{i}")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, total, gains in zip(batch["n"], batch["total"], batch["gains"], strict=True):
                if not n:
                    out.append(("und", 0.0))
                    continue
                total = total + gains[2:] / _UNIT + gains[0] * word_floor + gains[1] * gram_floor
                # Neighbouring words are not independent: twenty words are all the evidence.
                total = total * min(1.0, 20 / n)
                odds = np.exp(total - total.max())
                best = int(np.argmax(odds))
                out.append((langs[best], float(odds[best] / odds.sum())))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    columns = F.struct("n", "total", F.array(*map(gain_of, (-1, -2, *range(len(langs))))).alias("gains"))
    decided = F.pandas_udf(decide, "lang_pred string, score double")(columns).alias("_found")
    done = start.select("_id", "_row", "n", "total").join(sums, "_id", "left").select("_row", decided)
    return done.select(*(F.col("_row")[c].alias(c) for c in names), "_found.lang_pred", "_found.score")


@query("op9_word_backoff")
def op9_word_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit_backoff(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs, model, kept=("doc_id",))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
