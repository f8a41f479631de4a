"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased words (runs of letters and digits). A mask such as ``11101101`` is
laid on every word position of the benchmark and of the documents; the words under its
ones are hashed, the words under its zeros are ignored, so a substituted word under a zero
does not hide a match. Equal hashes of a document and an item place the item on a diagonal
of the document, and every such placement is verified word by word: equal words count 1,
unequal ones -1, and the best run on the diagonal must reach ``words`` (or the share
``part`` of a shorter item, but no less than ``least``).

Only DataFrame functions are used. The benchmark's seeds, and the placements found, are sent
to all tasks when they are counted to be few enough, and are joined by shuffling beyond
that; both give the same rows. Null and empty texts, and items or documents with fewer words than the mask is long,
match nothing. Rows that share an id are one document (or item). Of equally good runs the
earliest start counts. Very long texts are read whole. Empty tables give no rows, and other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.registry import let, query, table
from tallymill.session import stored

MASKS = ("11101101", "11011011")
#: Seeds of a benchmark, and placements, that are sent to every task; some 40 bytes each.
_SENT = 2_000_000


def words_column(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seeds(texts: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """(id, at, seed) for every word position and mask of ``texts`` (id, words)."""
    span = len(masks[0])
    if any(len(m) != span for m in masks):
        raise ValueError("masks must be equally long")

    def of(words: Column, number: int, mask: str) -> Column:
        picked = [i for i, bit in enumerate(mask) if bit == "1"]
        return F.transform(
            F.sequence(F.lit(0), F.size(words) - span),
            lambda at: F.struct(
                at.alias("at"), F.xxhash64(F.lit(number), *(F.get(words, at + i) for i in picked)).alias("seed")
            ),
        )

    def keyed(words: Column) -> Column:
        laid = F.concat(*(of(words, i, m) for i, m in enumerate(masks)))
        return F.when(F.size(words) >= span, laid)

    return texts.select("id", F.explode(let(F.col("words"), keyed)).alias("k")).select("id", "k.at", "k.seed")


def best_run(document: Column, item: Column, diagonal: Column) -> Column:
    """Largest sum of +1 for equal and -1 for unequal words in a run on the diagonal."""

    def run(r: Column) -> Column:
        first = F.greatest(F.lit(0), -r["diagonal"])
        last = F.least(F.size(r["item"]), F.size(r["document"]) - r["diagonal"]) - 1
        # The sum after each word and the best so far; a run that falls below 0 starts anew.
        return F.aggregate(
            F.sequence(first, last),
            F.struct(F.lit(0).alias("here"), F.lit(0).alias("best")),
            lambda a, j: let(
                F.greatest(
                    F.lit(0),
                    a["here"]
                    + F.when(F.get(r["document"], r["diagonal"] + j) == F.get(r["item"], j), 1).otherwise(-1),
                ),
                lambda here: F.struct(here.alias("here"), F.greatest(a["best"], here).alias("best")),
            ),
            lambda a: a["best"],
        )

    return let(F.struct(document.alias("document"), item.alias("item"), diagonal.alias("diagonal")), run)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    masks: tuple[str, ...] = MASKS,
    words: int = 13,
    part: float = 0.8,
    least: int = 8,
) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, start, score, item_words.

    ``start`` is the document's word on which the item's first word falls (negative if
    the item's beginning is missing), ``score`` the best run's sum.
    """
    documents = docs.select(F.col(key).alias("id"), words_column(F.col(text)).alias("words"))
    items = benchmark.select(F.col(item_key).alias("id"), words_column(F.col(item_text)).alias("words"))
    wanted = seeds(items, masks).select(F.col("id").alias("item"), F.col("at").alias("item_at"), "seed")
    wanted = wanted.distinct()
    if wanted.count() <= _SENT:
        wanted = F.broadcast(wanted)
    placed = (
        seeds(documents, masks)
        .join(wanted, "seed")
        .select("id", "item", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    # The placements are written, so their number is known: few are sent to the documents,
    # whose words then stay where they are.
    placed = stored(placed, "placed-items")
    if placed.count() <= _SENT:
        placed = F.broadcast(placed)
    held = items.select(F.col("id").alias("item"), F.col("words").alias("item_words"))
    scored = (
        documents.withColumnRenamed("id", "doc")
        .join(placed, F.col("id").eqNullSafe(F.col("doc")))
        .join(held.withColumnRenamed("item", "it"), F.col("item").eqNullSafe(F.col("it")))
        .select(
            "id",
            "item",
            "diagonal",
            F.size("item_words").alias("item_size"),
            best_run(F.col("words"), F.col("item_words"), F.col("diagonal")).alias("score"),
        )
    )
    needed = F.greatest(F.lit(least), F.least(F.lit(words), F.ceil(F.col("item_size") * part)))
    best = scored.filter(F.col("score") >= needed).groupBy("id", "item").agg(
        F.max(F.struct("score", (-F.col("diagonal")).alias("back"), "item_size")).alias("b")
    )
    return best.select(
        F.col("id").alias(key),
        F.col("item").alias(item_key),
        (-F.col("b.back")).cast("long").alias("start"),
        F.col("b.score").cast("long").alias("score"),
        F.col("b.item_size").cast("long").alias("item_words"),
    )


def _seed_sql(words: str, mask: str) -> str:
    return " || ' ' || ".join(f"{words}[pos + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")


_POSITIONS = "unnest(range(0, len(words) - 7)) AS pos"
_SEEDS = " UNION ALL ".join(
    f"SELECT id, pos, {n} AS mask, {_seed_sql('words', m)} AS seed FROM {{0}}_at" for n, m in enumerate(MASKS)
)
SQL = f"""
WITH doc AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words
  FROM documents WHERE text IS NOT NULL
), item AS (
  SELECT item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words
  FROM benchmark WHERE text IS NOT NULL
), doc_at AS (SELECT id, words, {_POSITIONS} FROM doc WHERE len(words) >= 8),
item_at AS (SELECT id, words, {_POSITIONS} FROM item WHERE len(words) >= 8),
doc_seed AS ({_SEEDS.format("doc")}),
item_seed AS ({_SEEDS.format("item")}),
placed AS (
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.pos - i.pos AS diagonal
  FROM doc_seed d JOIN item_seed i ON d.mask = i.mask AND d.seed = i.seed
), step AS (
  SELECT p.*, len(item.words) AS item_words, j,
    CASE WHEN doc.words[diagonal + j + 1] = item.words[j + 1] THEN 1 ELSE -1 END AS step
  FROM placed p JOIN doc ON doc.id = p.doc_id JOIN item ON item.id = p.item_id,
    unnest(range(greatest(0, -diagonal), least(len(item.words), len(doc.words) - diagonal))) AS u(j)
), total AS (
  SELECT *, sum(step) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j) AS total FROM step
), low AS (
  SELECT *, coalesce(min(total) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS low FROM total
), scored AS (
  SELECT doc_id, item_id, diagonal, item_words, max(total - least(low, 0)) AS score
  FROM low GROUP BY ALL
)
SELECT doc_id, item_id, CAST(arg_min(diagonal, struct_pack(s := -score, d := diagonal)) AS BIGINT) AS start,
  CAST(max(score) AS BIGINT) AS score, CAST(max(item_words) AS BIGINT) AS item_words
FROM scored WHERE score >= greatest(8, least(13, ceil(item_words * 0.8)))
GROUP BY doc_id, item_id
"""


@query("op1_spaced_seeds", SQL)
def op1_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that documents hold, one row per document and item."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
