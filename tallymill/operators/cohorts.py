"""Cohort retention and recency/frequency segmentation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.columns import regex_recode
from tallymill.operators.ranking import quantile_score
from tallymill.operators.windows import period_index

# Pattern of recency score then frequency score, and the segment's name.
SEGMENTS = {
    "[1-2][1-2]": "Hibernating",
    "[1-2][3-4]": "At-Risk",
    "[1-2]5": "Can't Lose",
    "3[1-2]": "About to Slip",
    "33": "Need Attention",
    "[3-4][4-5]": "Loyal Customers",
    "41": "Promising",
    "51": "New Customers",
    "[4-5][2-3]": "Potential Loyalists",
    "5[4-5]": "Champions",
}


def cohort_activity(
    df: DataFrame,
    customer: str,
    ts: str,
    unit: str = "quarter",
    sums: Mapping[str, Column] | None = None,
    calendar: bool = False,
) -> DataFrame:
    """One row per customer and active period, with cohort and age.

    Rows are first reduced to (customer, period) with partial sums, so a customer with
    a third of all rows becomes as many rows as there are periods. ``sums`` adds
    summed expressions; ``rows`` counts the source rows. Ages count the periods present
    in the table unless ``calendar`` is set.
    """
    sums = dict(sums or {})
    start = F.trunc(F.col(ts), unit)
    active = (
        df.where(F.col(customer).isNotNull() & F.col(ts).isNotNull())
        .groupBy(customer, start.alias("_period"))
        .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(e).alias(n) for n, e in sums.items()])
    )
    placed = period_index(active, "_period", unit, "period_id", calendar)
    mine = Window.partitionBy(customer)
    return placed.select(
        customer,
        "period_id",
        F.min("period_id").over(mine).alias("cohort_id"),
        F.min("period_id_start").over(mine).alias("cohort_start"),
        (F.col("period_id") - F.min("period_id").over(mine)).alias("age"),
        "rows",
        *sums,
    )


def retention(activity: DataFrame) -> DataFrame:
    """Active customers and rounded retention percent per cohort and age (long form)."""
    counts = activity.groupBy("cohort_id", "cohort_start", "age").agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    size = F.max(F.when(F.col("age") == 0, F.col("n_customers"))).over(
        Window.partitionBy("cohort_id")
    )
    return counts.withColumn("retention", F.bround(F.col("n_customers") / size, 2) * 100)


def rfm_table(df: DataFrame, customer: str, ts: str, amount: Column) -> DataFrame:
    """Recency (whole days to the day after the last row), frequency and money."""
    latest = df.agg(F.max(ts) + F.expr("interval 1 day")).scalar()
    return (
        df.where(F.col(customer).isNotNull())
        .groupBy(customer)
        .agg(
            F.max(ts).alias("_last"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum(amount).alias("monetary_value"),
        )
        .withColumn("_latest", latest)
        .select(
            customer,
            F.timestamp_diff("DAY", F.col("_last"), F.col("_latest")).cast("int").alias("recency"),
            "frequency",
            "monetary_value",
        )
    )


def rfm_segments(
    rfm: DataFrame, customer: str, segments: Mapping[str, str] = SEGMENTS, parts: int = 5
) -> DataFrame:
    """Add recency and frequency scores 1..``parts`` and the segment label.

    Recency is scored by exact quantile edges, frequency by rank with ties broken by
    the customer key. Money is reported, not scored.
    """
    labels: Sequence[int] = range(1, parts + 1)
    scored = quantile_score(rfm, "recency", list(reversed(labels)), "recency_score")
    scored = quantile_score(scored, "frequency", list(labels), "frequency_score", tie=customer)
    code = F.concat(F.col("recency_score").cast("string"), F.col("frequency_score").cast("string"))
    return scored.withColumn("rfm_segment", regex_recode(code, segments))
