"""A corpus from documents to training sequences, one operator per stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All stages but the last return the
columns of ``documents``. A row is told apart by its id and its text, so rows that share an
id, or have none, are each judged by their own text; rows equal in both are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.decontamination import contaminated
from tallymill.llm.near_duplicates import near_duplicates, row_name
from tallymill.llm.packing import retrieval_pack
from tallymill.llm.personal_data import sanitise
from tallymill.llm.quality import fit_quality, learnable, score_quality
from tallymill.llm.registry import table
from tallymill.session import small_batches, stored

# Learnt models and iterative grouping have no SQL form; tests hold the stages against
# brute force instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.5 or more stay."""
    small_batches(spark)
    machine = fit_quality(learnable(docs), table(spark, sf_dir, "labels"), metadata=("n_chars",))
    scored = score_quality(docs, machine, metadata=("n_chars",), score="_quality")
    return scored.filter(F.col("_quality") >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    small_batches(spark)
    kept = near_duplicates(docs).filter("keep").select(F.col("doc").alias("_doc"), F.col("spot").alias("_spot"))
    doc, spot = row_name(F.col("doc_id"), F.col("text"))
    named = docs.withColumns({"_doc": doc, "_spot": spot})
    return (
        named.join(kept, ["_doc", "_spot"], "left_semi").dropDuplicates(["_doc", "_spot"]).select(*docs.columns)
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    named = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = contaminated(named, table(spark, sf_dir, "benchmark"), key="_row").select("_row").distinct()
    return named.join(found, "_row", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are replaced; ``n_chars`` follows the text."""
    clean = sanitise(docs, names=("_base", "_spans", "_sanitised"))
    new = {"text": F.col("_sanitised"), "n_chars": F.length("_sanitised").cast("long")}
    return clean.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents that were kept, packed into sequences of at most 1024 tokens."""
    small_batches(spark)
    return retrieval_pack(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and reread, from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
