"""Calendar columns, period filters and deterministic seasonal terms."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

# Upper hour of each day part, and its label.
DAY_PART_EDGES = (-1, 5, 11, 17, 23)
DAY_PARTS = ("Night", "Morning", "Afternoon", "Evening")
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def cut(value: Column, edges, labels) -> Column:
    """Label of the right-closed interval ``(edges[i], edges[i+1]]``; null outside all."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        inside = (value > F.lit(lo)) & (value <= F.lit(hi))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def day_part(ts: Column) -> Column:
    return cut(F.hour(ts), DAY_PART_EDGES, DAY_PARTS)


def calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Add the ten calendar columns of timestamp ``ts`` (Monday is day 0)."""
    t = F.col(ts)
    return df.select(
        "*",
        F.hour(t).alias("hour"),
        F.weekday(t).alias("dayofweek"),
        F.date_format(t, "EEEE").alias("dayname"),
        F.quarter(t).alias("quarter"),
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofyear(t).alias("dayofyear"),
        F.dayofmonth(t).alias("dayofmonth"),
        F.weekofyear(t).alias("weekofyear"),
        day_part(t).alias("timeofday"),
    )


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def quarter_label(ts: Column) -> Column:
    """``Q1/2010``."""
    return F.concat(F.lit("Q"), F.quarter(ts), F.lit("/"), F.year(ts))


def _period_bounds(text: str) -> tuple[dt.date, dt.date]:
    parts = [int(p) for p in text.split("-")]
    if len(parts) == 1:
        return dt.date(parts[0], 1, 1), dt.date(parts[0] + 1, 1, 1)
    if len(parts) == 2:
        year, month = parts
        return dt.date(year, month, 1), dt.date(year + month // 12, month % 12 + 1, 1)
    day = dt.date(*parts)
    return day, day + dt.timedelta(days=1)


def in_periods(df: DataFrame, col: str, lo: str | None = None, hi: str | None = None) -> Column:
    """Condition: ``col`` lies in the partial dates ``lo``..``hi``, both periods included.

    Compares the bare column with a literal of its own type, so the scan gets the filter.
    """
    kind = df.schema[col].dataType

    def bound(day: dt.date) -> Column:
        if isinstance(kind, (DateType, TimestampType)):
            return F.lit(day.isoformat()).cast(kind)
        return F.lit(f"{day.isoformat()} 00:00:00").cast(kind)

    condition = F.lit(True)
    if lo is not None:
        condition = F.col(col) >= bound(_period_bounds(lo)[0])
    if hi is not None:
        upper = F.col(col) < bound(_period_bounds(hi)[1])
        condition = upper if lo is None else condition & upper
    return condition


def between_periods(df: DataFrame, col: str, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Rows whose date lies in ``'2017'``, ``'2017-01'`` or ``'2017-01-31'`` style bounds."""
    return df.where(in_periods(df, col, lo, hi))


def seasonal_terms(date: Column, origin: Column, order: int = 4) -> dict[str, Column]:
    """Constant, linear trend, weekday dummies, Fourier terms of the month, New Year flag.

    Monday is the base weekday: with a constant, all seven would be collinear. The
    Fourier phase is the share of the month that has passed.
    """
    terms = {
        "const": F.lit(1.0),
        "trend": (F.datediff(date, origin) + 1).cast("double"),
    }
    for day in range(1, 7):
        terms[f"weekday_{day}"] = (F.weekday(date) == day).cast("double")
    phase = (F.dayofmonth(date) - 1) / F.dayofmonth(F.last_day(date))
    for k in range(1, order + 1):
        terms[f"sin_{k}"] = F.sin(phase * (2.0 * math.pi * k))
        terms[f"cos_{k}"] = F.cos(phase * (2.0 * math.pi * k))
    terms["new_year"] = (F.dayofyear(date) == 1).cast("double")
    return terms


def future_dates(df: DataFrame, date: str, steps: int) -> DataFrame:
    """The ``steps`` days after the last date of ``df``."""
    last = df.agg(F.max(date).cast("date").alias("last"))
    return last.where(F.col("last").isNotNull()).select(
        F.explode(
            F.sequence(F.date_add("last", 1), F.date_add("last", steps), F.expr("interval 1 day"))
        ).alias(date)
    )
