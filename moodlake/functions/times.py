"""Dates, slots and collection windows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMP = "yyyyMMddHHmmss"


def parse_iso_date(c: Column) -> Column:
    """Date of a 'YYYY-MM-DD' text; anything else becomes null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def date_in_path(path: Column) -> Column:
    """Date of the folder ``YYYY-MM-DD`` or ``date=YYYY-MM-DD`` in a path, else null."""
    return parse_iso_date(F.regexp_extract(path, r"/(?:date=)?(\d{4}-\d{2}-\d{2})/", 1))


def stamp_to_timestamp(c: Column) -> Column:
    """Timestamp of a 14-digit text, null if it is not one."""
    return F.try_to_timestamp(c, F.lit(STAMP))


def on_day(stamp: Column, day: date | str) -> Column:
    """Is the 14-digit text on this day? A prefix test, so it reaches the file scan."""
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return stamp.startswith(day.strftime("%Y%m%d"))


def epoch_to_iso(epoch_seconds: Column) -> Column:
    """Unix seconds to ISO text, UTC, no zone suffix."""
    return F.date_format(F.timestamp_seconds(epoch_seconds), "yyyy-MM-dd'T'HH:mm:ss")


def within(df: DataFrame, ts: str, start: datetime | str, end: datetime | str, bounds: str = "half_open") -> DataFrame:
    """Rows in a time range: ``'half_open'`` is [start, end), ``'closed'`` is [start, end].

    The bounds are cast to the column's own type and the column is left bare, so the
    predicate is pushed to the file scan.
    """
    kind = df.schema[ts].dataType
    low, high = (F.lit(str(v)).cast(kind) for v in (start, end))
    upper = {"half_open": F.col(ts) < high, "closed": F.col(ts) <= high}
    if bounds not in upper:
        raise ValueError(f"bounds must be 'half_open' or 'closed', not {bounds!r}")
    return df.filter((F.col(ts) >= low) & upper[bounds])


def slot_grid(spans: DataFrame, start: str, end: str, minutes: int = 15) -> DataFrame:
    """One row per slot of each span, both ends included, seconds zeroed.

    Columns of ``spans`` other than the two ends are kept.
    """
    step = F.expr(f"interval {int(minutes)} minutes")
    first = F.date_trunc("minute", F.col(start)).cast("timestamp")
    keep = [c for c in spans.columns if c not in (start, end)]
    return (
        spans.filter(F.col(start) <= F.col(end))
        .select(*keep, F.explode(F.sequence(first, F.col(end).cast("timestamp"), step)).alias("slot"))
        .withColumn("stamp", F.date_format("slot", STAMP))
    )


@dataclass(frozen=True)
class RunSchedule:
    """Two runs a day. Times are hours from midnight of the run's day."""

    split_hour: int = 13
    morning_start: float = -5.0
    morning_end: float | None = 12.5
    evening_start: float = 12.5
    evening_end: float | None = 19.0
    lag_hours: float = 0.0


# The two published schedules. ``None`` means "up to the run itself".
POST_SCHEDULE = RunSchedule()
NEWS_SCHEDULE = RunSchedule(
    morning_start=-6.0, morning_end=None, evening_start=11.5, evening_end=None, lag_hours=1.0
)


def _at(day: Column, hours: float) -> Column:
    return day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(hours * 60)), F.lit(0))


def run_windows(runs: DataFrame, run_ts: str, schedule: RunSchedule = POST_SCHEDULE) -> DataFrame:
    """The window each run collects: adds run_id, start_ts, end_ts.

    A run before ``split_hour`` is the morning run, any other the evening run.
    """
    now = F.col(run_ts).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(schedule.lag_hours * 60)), F.lit(0))
    day = F.to_date(now).cast("timestamp_ntz")
    morning = F.hour(now) < schedule.split_hour

    def end(hours: float | None) -> Column:
        return now if hours is None else _at(day, hours)

    return runs.select(
        "*",
        F.concat(F.date_format(now, "yyyy-MM-dd"), F.when(morning, "-am").otherwise("-pm")).alias("run_id"),
        F.when(morning, _at(day, schedule.morning_start)).otherwise(_at(day, schedule.evening_start)).alias("start_ts"),
        F.when(morning, end(schedule.morning_end)).otherwise(end(schedule.evening_end)).alias("end_ts"),
    )


def calendar(df: DataFrame, day: str = "date", keys: list[str] | None = None, shared: bool = False) -> DataFrame:
    """Every date from the first to the last, one row each and per key.

    A key's own first and last date, or with ``shared`` those of the whole frame. The
    ends come from aggregates, the dates from the key's one row: no cross join.
    """
    keys = keys or []
    every_day = F.expr("interval 1 day")
    if shared and keys:
        low, high = df.agg(F.min(day)).scalar(), df.agg(F.max(day)).scalar()
        return df.select(*keys).distinct().select(*keys, F.explode(F.sequence(low, high, every_day)).alias(day))
    span = df.groupBy(*keys).agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return span.filter(F.col("_lo").isNotNull()).select(*keys, F.explode(F.sequence("_lo", "_hi", every_day)).alias(day))
