"""Features of panels: many daily series keyed by family and store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.labels import with_codes
from tallymill.operators.reshape import dummies, dummy_name, fit_labels
from tallymill.operators.windows import lag_of, series_window, time_index, trailing_mean


@dataclass(frozen=True)
class PanelColumns:
    """Names of the panel's columns."""

    family: str = "family"
    store: str = "store"
    date: str = "date"
    value: str = "sales"


@dataclass
class FeatureSpec:
    """What training fixed for later rows: dummy labels, lags and rolling widths.

    A ``wide`` spec has a dummy and a slope column per store. Otherwise ``stores`` holds the
    first store only, and any number of others share two columns: ``store_own``, 1 in all
    rows but the first store's, and ``store_time``, the time index there. A model with
    coefficients of its own per store (:func:`fit_blocked_ridge`) is then the same model.
    """

    stores: list
    weekdays: list = field(default_factory=lambda: list(range(7)))
    months: list = field(default_factory=lambda: list(range(1, 13)))
    lags: list = field(default_factory=list)
    rolls: list = field(default_factory=list)
    wide: bool = True

    def to_dict(self) -> dict:
        return asdict(self)

    def linear_columns(self) -> list[str]:
        """Time index, dummies without their first label, and one slope per further store."""
        return (
            ["time_idx"]
            + [dummy_name("dayofweek", v) for v in self.weekdays[1:]]
            + [dummy_name("month", v) for v in self.months[1:]]
            + [dummy_name("store", v) for v in self.stores[1:]]
            + self.slope_columns()
        )

    def shared_columns(self) -> list[str]:
        """The linear features that all stores share."""
        return (
            ["time_idx"]
            + [dummy_name("dayofweek", v) for v in self.weekdays[1:]]
            + [dummy_name("month", v) for v in self.months[1:]]
        )

    def own_columns(self) -> list[str]:
        """The linear features with a coefficient per store, in a spec that is not wide."""
        return ["store_own", "store_time"]

    def slope_columns(self) -> list[str]:
        return [dummy_name("store", v) + "_time" for v in self.stores[1:]]

    def tree_columns(self) -> list[str]:
        """Lags, rolling means, year and the full set of dummies."""
        return (
            [f"lag_{k}" for k in self.lags]
            + [f"roll_{w}" for w in self.rolls]
            + ["year"]
            + ([dummy_name("store", v) for v in self.stores] if self.wide else ["store_code"])
            + [dummy_name("dayofweek", v) for v in self.weekdays]
            + [dummy_name("month", v) for v in self.months]
        )


def fit_spec(
    df: DataFrame,
    cols: PanelColumns = PanelColumns(),
    lags: Sequence[int] = (),
    rolls: Sequence[int] = (),
    wide: bool = True,
) -> FeatureSpec:
    """Labels present in the training rows; of the stores only the first unless ``wide``."""
    if not wide:
        days, months, first = df.agg(
            F.sort_array(F.collect_set(F.weekday(cols.date))),
            F.sort_array(F.collect_set(F.month(cols.date))),
            F.min(cols.store),
        ).first()
        return FeatureSpec([first], list(days), list(months), list(lags), list(rolls), False)
    calendar = df.select(
        F.col(cols.store).alias("s"),
        F.weekday(cols.date).alias("w"),
        F.month(cols.date).alias("m"),
    )
    found = fit_labels(calendar, ["s", "w", "m"])
    return FeatureSpec(found["s"], found["w"], found["m"], list(lags), list(rolls))


def fill_panel(
    df: DataFrame, keys: Sequence[str], date: str, value: str, lo: Column | None = None, hi: Column | None = None
) -> DataFrame:
    """One row per series and day between the first and last day, 0 where there was none.

    Each distinct series makes its own days, so nothing is joined without a key. Rows
    without a key or a date belong to no series and are dropped.
    """
    df = df.dropna(subset=[*keys, date])
    ends = df.agg(
        F.struct(F.min(date).alias("lo"), F.max(date).alias("hi")).alias("v")
    ).scalar()
    lo = ends["lo"] if lo is None else lo
    hi = ends["hi"] if hi is None else hi
    days = (
        df.select(*keys)
        .distinct()
        .withColumn(date, F.explode(F.sequence(lo, hi, F.expr("interval 1 day"))))
    )
    return days.join(df, [*keys, date], "left").select(
        *keys, date, F.coalesce(F.col(value), F.lit(0.0)).alias(value)
    )


def add_dummies(
    df: DataFrame, spec: FeatureSpec, cols: PanelColumns = PanelColumns(), codes: DataFrame | None = None
) -> DataFrame:
    """All dummy columns and the store slopes, with the training labels.

    With a spec that is not wide, the two columns that stand for them, and the stores'
    numbers from ``codes`` (:func:`label_index` of the store column) if given.
    """
    made = {}
    made.update(dummies("dayofweek", spec.weekdays))
    made.update(dummies("month", spec.months))
    if not spec.wide:
        own = F.coalesce((F.col(cols.store) != F.lit(spec.stores[0])).cast("int"), F.lit(0))
        made |= {"store_own": own, "store_time": own * F.col("time_idx")}
        out = df.withColumns(made)
        if codes is None:
            return out
        return with_codes(out, codes, [cols.store]).withColumnRenamed(f"{cols.store}_code", "store_code")
    made.update(dummies(cols.store, spec.stores, prefix="store"))
    slopes = {
        dummy_name("store", v) + "_time": F.when(F.col(cols.store) == F.lit(v), F.col("time_idx")).otherwise(0)
        for v in spec.stores[1:]
    }
    return df.withColumns({**made, **slopes})


def build_features(
    df: DataFrame,
    lags: Sequence[int] = (1, 7, 28),
    rolls: Sequence[int] = (7,),
    cols: PanelColumns = PanelColumns(),
    spec: FeatureSpec | None = None,
    activity_lags: Sequence[int] = (1, 7),
    codes: DataFrame | None = None,
) -> DataFrame:
    """Features of all families in one lazy plan.

    Adds the time index of the family's dates, calendar parts, lags and trailing means
    within each series, ``is_active`` (sold at one of ``activity_lags``), and with a
    ``spec`` the dummies and store slopes. Rows without a full history are dropped.
    """
    keys = [cols.family, cols.store]
    out = time_index(df, cols.date, [cols.family]).withColumns(
        {
            "dayofweek": F.weekday(cols.date),
            "month": F.month(cols.date),
            "year": F.year(cols.date),
        }
    )
    wanted = sorted({*lags, *activity_lags})
    exprs = {f"lag_{k}": lag_of(cols.value, k) for k in wanted}
    exprs.update({f"roll_{w}": trailing_mean(cols.value, w) for w in rolls})
    reach = max([*wanted, *rolls])
    out = series_window(out, keys, [cols.date], exprs, reach)
    active = F.lit(False)
    for k in activity_lags:
        active = active | F.coalesce(F.col(f"lag_{k}") > 0, F.lit(False))
    out = out.withColumn("is_active", active.cast("int"))
    complete = [f"lag_{k}" for k in lags] + [f"roll_{w}" for w in rolls]
    out = out.na.drop("any", subset=complete) if complete else out
    out = out.drop(*[f"lag_{k}" for k in wanted if k not in lags])
    return out if spec is None else add_dummies(out, spec, cols, codes)


def date_index(df: DataFrame, cols: PanelColumns = PanelColumns()) -> DataFrame:
    """The training time index to keep: one row per family and date."""
    return (
        time_index(df.select(cols.family, cols.date).distinct(), cols.date, [cols.family])
        .select(cols.family, F.col(cols.date).cast("date").alias("_day"), "time_idx")
    )


def build_forecast_features(
    df: DataFrame,
    spec: FeatureSpec,
    index: DataFrame | None = None,
    cols: PanelColumns = PanelColumns(),
    codes: DataFrame | None = None,
) -> DataFrame:
    """Features that exist for future rows: time index, calendar, dummies, slopes.

    ``index`` is the kept training index; a date after its last one continues by
    calendar days. Labels not seen in training are 0 in every dummy.
    """
    if index is None:
        out = time_index(df, cols.date, [cols.family])
    else:
        last = index.groupBy(cols.family).agg(
            F.max("time_idx").alias("_max_idx"), F.max("_day").alias("_last")
        )
        out = (
            df.withColumn("_day", F.col(cols.date).cast("date"))
            .join(index, [cols.family, "_day"], "left")
            .join(last, cols.family, "left")
            .withColumn(
                "time_idx",
                F.coalesce("time_idx", F.col("_max_idx") + F.datediff("_day", "_last")),
            )
            .drop("_day", "_max_idx", "_last")
        )
    out = out.withColumns(
        {
            "dayofweek": F.weekday(cols.date),
            "month": F.month(cols.date),
            "year": F.year(cols.date),
        }
    )
    return add_dummies(out, spec, cols, codes)
