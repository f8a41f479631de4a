"""Tokens of each section of a document, from one encoding of the whole document.

A document is its fields joined by a separator. It is encoded once, every token's span is
recovered from the bytes that its id stands for, and the spans are joined to the spans of
the sections. A token that crosses a boundary is allocated by a rule:

* ``first``: to the section that holds its first byte;
* ``majority``: to the section that holds most of its bytes, the earlier one of equals;
* ``share``: to every section by its share of the token's bytes.

The counts of a document's sections add up to the document's tokens under every rule. A
separator belongs to the section before it. Null fields count as empty, an empty section
has a row with no tokens, and rows that repeat are counted as often as they come. Very long
texts are encoded whole, an empty table has no rows, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.chunks import encoder
from tallymill.llm.packing import vocabulary_files
from tallymill.llm.registry import query, table

RULES = ("first", "majority", "share")


def allocate(starts: np.ndarray, ends: np.ndarray, edges: np.ndarray, rule: str) -> np.ndarray:
    """Tokens per section, for token spans in bytes and sections ``edges[i]:edges[i + 1]``."""
    sections = len(edges) - 1
    # Empty sections share their start with the next one, which holds the byte.
    first = np.searchsorted(edges, starts, side="right") - 1
    last = np.searchsorted(edges, np.maximum(ends - 1, starts), side="right") - 1
    inside = first == last
    if rule == "first":
        return np.bincount(first, minlength=sections).astype(float)
    counts = np.bincount(first[inside], minlength=sections).astype(float)
    for i in np.flatnonzero(~inside):
        over = np.arange(first[i], last[i] + 1)
        held = np.minimum(edges[over + 1], ends[i]) - np.maximum(edges[over], starts[i])
        if rule == "majority":
            counts[over[np.argmax(held)]] += 1
        else:
            counts[over] += held / held.sum()
    return counts


def attribute_tokens(
    docs: DataFrame,
    fields: tuple[str, ...] = ("text",),
    key: str = "doc_id",
    by_line: bool = True,
    rule: str = "first",
    separator: str = "\n",
    files: tuple[str, str, str] | None = None,
) -> DataFrame:
    """One row per section: field, its number there, its span in the field, its tokens.

    With ``by_line`` a section is a line with its line feed, otherwise the whole field.
    ``start_char`` and ``end_char`` count code points, the end is exclusive.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocabulary = files or vocabulary_files()
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.array(*(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)).alias("values"),
    )
    schema = (
        "doc_id long, field string, section int, start_char long, end_char long, "
        "n_tokens double, doc_tokens long"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(*vocabulary)
        for batch in batches:
            for at in range(0, len(batch), 500):
                out = []
                part = batch.iloc[at : at + 500]
                for doc, values in zip(part["doc_id"].tolist(), part["values"], strict=True):
                    ids = encode.ids(separator.join(values))
                    ends = np.cumsum(encode.sizes[ids])
                    edges, spans = [0], []
                    for name, value, last in zip(fields, values, [*[False] * (len(values) - 1), True], strict=True):
                        lines = value.split("\n") if by_line else [value]
                        begin = 0
                        for i, line in enumerate(lines):
                            tail = "\n" if i + 1 < len(lines) else ""
                            spans.append((name, i, begin, begin + len(line) + len(tail)))
                            begin += len(line) + len(tail)
                            size = len((line + tail).encode())
                            if i + 1 == len(lines) and not last:
                                size += len(separator.encode())
                            edges.append(edges[-1] + size)
                    counts = allocate(ends - encode.sizes[ids], ends, np.asarray(edges), rule)
                    out.extend(
                        (doc, *span, n, len(ids)) for span, n in zip(spans, counts.tolist(), strict=True)
                    )
                yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, schema)


@query("op8_token_attribution")
def op8_token_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every line of every document; a line feed's token goes where it starts."""
    counted = attribute_tokens(table(spark, folder, "documents"))
    return counted.withColumn("n_tokens", F.col("n_tokens").cast("long"))
