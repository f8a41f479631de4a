"""Small corpora with every odd case, and pandas access to results."""

from __future__ import annotations

import random

WORDS = "alder birch cedar ebony fir hazel juniper larch maple oak pine rowan spruce willow yew".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 99)) * draw.randint(0, 1) for _ in range(words))


def odd_docs(spark, rows: list[tuple[int | None, str | None]] = ()):
    """Nulls, empty and very long texts, repeated rows, and clashing extra columns."""
    base = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "tie tie tie tie"), (5, "tie tie tie tie"),
        (6, prose(6, 60)), (7, prose(6, 60)), (8, prose(8, 9000)), (9, "<|endoftext|> ünï 日本語 \U0001f600 x"),
        (None, "no id at all"),
    ]
    data = [(i, t, "en", 1.5, "x", 3, 7) for i, t in [*base, *rows]]
    schema = "doc_id long, text string, lang string, score double, spans string, shard int, n_chars long"
    return spark.createDataFrame(data, schema)


def empty_docs(spark):
    return odd_docs(spark).limit(0)


def rows(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]
