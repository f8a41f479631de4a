"""Bounded samples of labelled rows, and hashed text features."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """``docs`` with their ``label`` (0 or 1), about ``rows`` of them at most.

    The draw is by the hash of the key, so a rerun draws the same rows. Only the labels
    are counted and drawn from before the texts are read; the drawn ones are few enough
    by construction to be sent to every task. A document that is labelled more than once
    has the label that it has more often, and the lower one of a tie.
    """
    clean = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(key)
        .agg(F.avg(F.col(label)).alias("share"))
        .select(key, (F.col("share") > 0.5).cast("int").alias("_label"))
    )
    count = clean.count()
    if count > rows:
        draw = F.pmod(F.xxhash64(F.col(key), F.lit("labels")), F.lit(1_000_000)) / 1_000_000
        clean = clean.filter(draw < F.lit(rows / count))
    return docs.join(F.broadcast(clean), key)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def hashed(terms: Iterable[str], buckets: int) -> np.ndarray:
    """The distinct buckets of ``terms``."""
    found = {zlib.crc32(t.encode("utf-8", "surrogatepass")) % buckets for t in terms}
    return np.fromiter(found, np.int32, len(found))


def structure(text: str) -> dict[str, float]:
    """Statistics of how a text is built, each bounded or in powers of two."""
    words, lines = text.split(), text.split("\n")
    size, count = max(1, len(text)), max(1, len(words))
    letters = sum(map(str.isalpha, text))
    spaces = text.count(" ") + text.count("\n") + text.count("\t")
    digits = sum(map(text.count, "0123456789"))
    common = Counter(words).most_common(3)
    repeats = sum(map(str.__eq__, words, words[1:]))
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" for w in words)
    full = [x for x in lines if x.strip()]
    return {
        "size": np.log2(1 + len(text)),
        "words": np.log2(1 + len(words)),
        "word_length": min(20.0, (size - spaces) / count),
        "letters": 20 * letters / size,
        "symbols": 40 * max(0, size - letters - spaces - digits) / size,
        "digits": 40 * digits / size,
        "upper": 40 * sum(w[0].isupper() for w in words) / count,
        "distinct": 20 * len(set(words)) / count,
        "top": 40 * (common[0][1] if common else 0) / count,
        "top_three": 20 * sum(n for _, n in common) / count,
        "repeats": 20 * repeats / count,
        "marked": 20 * marked / count,
        "bars": 20 * text.count("|") / count,
        "lines": np.log2(1 + len(full)),
        "line_length": np.log2(1 + size / max(1, len(full))),
        "same_lines": 20 * (1 - len(set(full)) / max(1, len(full))),
        "closed_lines": 10 * sum(x.rstrip()[-1] in ".!?" for x in full) / max(1, len(full)),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
