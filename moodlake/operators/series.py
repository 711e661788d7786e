"""Operators on daily series: carry-forward, z-scores, latest row.

A series has one row per key and day (see ``daily_last_value``), so even the window of
a single series without a key is a few hundred rows a year. Aggregate to days first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodlake.session import settle


def _day_number(day: str) -> Column:
    return F.unix_date(F.col(day))


def carry_forward(
    grid: DataFrame, value: str = "value", day: str = "date", keys: Sequence[str] = (), max_age: int = 7,
    default: float | None = None, mode: str = "observed",
) -> DataFrame:
    """Fill days without a value from the last earlier day that has one.

    ``grid`` holds every day of each key, with null where nothing was observed.
    ``'observed'`` looks back at most ``max_age`` days; 0 means the default at once.
    ``'chained'`` treats a filled day as observed on the next one, as a job that stores
    its own fill does, so the last value never expires. Adds ``filled`` and
    ``age_days`` (0 observed, null for the default).
    """
    if mode not in ("observed", "chained"):
        raise ValueError(f"mode must be 'observed' or 'chained', not {mode!r}")
    w = Window.partitionBy(*keys).orderBy(_day_number(day))
    if mode == "observed":
        w = w.rangeBetween(-max_age, 0)
    else:
        w = w.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(F.col(value).isNotNull(), F.struct(F.col(day).alias("d"), F.col(value).alias("v")))
    last = F.last(seen, ignorenulls=True).over(w)
    return (
        grid.withColumn("_last", last)
        .withColumn("filled", F.coalesce(F.col("_last.v"), F.lit(default).cast("double")))
        .withColumn("age_days", F.date_diff(day, F.col("_last.d")))
        .drop("_last")
    )


def carry_rows(
    rows: DataFrame, day: str = "date", keys: Sequence[str] = (), max_age: int = 6, mode: str = "observed"
) -> DataFrame:
    """All rows of a day, or on a day without any, those of the last earlier day.

    Covers every day from the first to the last of the frame. A day whose last earlier
    day is more than ``max_age`` days back stays empty, unless ``mode`` is 'chained'.
    Adds ``source_day``. The map from days to source days is as small as a calendar; it
    is written first so that Spark joins it by its true size.
    """
    if mode not in ("observed", "chained"):
        raise ValueError(f"mode must be 'observed' or 'chained', not {mode!r}")
    keys = list(keys)
    have = rows.select(*keys, F.col(day).alias("source_day")).filter(F.col(day).isNotNull()).distinct()
    until = rows.agg(F.max(day)).scalar()
    days = settle(_reach(have, "source_day", keys, max_age if mode == "observed" else None, until, day), "days")
    return rows.withColumnRenamed(day, "source_day").join(days, [*keys, "source_day"])


def _reach(have: DataFrame, day: str, keys: Sequence[str], max_age: int | None, until: Column | None, out: str) -> DataFrame:
    """Each row for every day it is the latest for: up to the day before the key's next row, and
    no more than ``max_age`` days. The last row of a key reaches to ``until``."""
    after = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    last = F.coalesce(F.date_sub(after, 1), F.greatest(F.col(day), until) if until is not None else F.col(day))
    if max_age is not None:
        last = F.least(last, F.date_add(day, max_age))
    return have.withColumn("_last", last).select("*", F.explode(F.sequence(day, "_last")).alias(out)).drop("_last")


def as_of(
    observed: DataFrame, value: str = "value", day: str = "date", keys: Sequence[str] = (), max_age: int | None = 7,
    default: float | None = None, until: Column | None = None,
) -> DataFrame:
    """Every day from a key's first observation to its last (or to ``until``), with the value of
    the latest observation up to it and its age in days.

    ``observed`` has one row per key and day; null values do not count. A value older than
    ``max_age`` days is not carried: such days have ``default``, or no row without one. With
    ``max_age=None`` values never expire. One window over the observations; days are made from
    the gaps, so keys are not multiplied by a calendar.
    """
    rows = observed.filter(F.col(value).isNotNull()).select(*keys, F.col(day).alias("_day"), F.col(value).alias("_value"))
    reach = _reach(rows, "_day", keys, max_age if default is None else None, until, day)
    age = F.date_diff(day, "_day")
    fresh = F.lit(True) if max_age is None else age <= max_age
    return reach.select(
        *keys, day, F.when(fresh, F.col("_value")).otherwise(F.lit(default)).alias("filled"), F.when(fresh, age).alias("age_days")
    )


def _spread(value: str, ddof: int):
    return F.stddev_samp(value) if ddof == 1 else F.stddev_pop(value)


def _score(value: str, mean: Column, spread: Column) -> Column:
    return F.when(spread > 0, (F.col(value) - mean) / spread)


def zscore(df: DataFrame, value: str = "value", keys: Sequence[str] = (), ddof: int = 1) -> DataFrame:
    """(x - mean) / standard deviation over the whole series; null for a constant one."""
    w = Window.partitionBy(*keys)
    return df.withColumn("zscore", _score(value, F.avg(value).over(w), _spread(value, ddof).over(w)))


def zscore_rolling(
    df: DataFrame, value: str = "value", day: str = "date", keys: Sequence[str] = (), days: int = 7, ddof: int = 1
) -> DataFrame:
    """The same over the ``days`` calendar days that end on the row's day."""
    w = Window.partitionBy(*keys).orderBy(_day_number(day)).rangeBetween(-(days - 1), 0)
    return df.withColumn("zscore", _score(value, F.avg(value).over(w), _spread(value, ddof).over(w)))


def latest(df: DataFrame, *order: str, n: int = 1) -> DataFrame:
    """The last ``n`` rows: a top-n, not a full sort."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
