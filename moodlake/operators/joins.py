"""Joins the jobs need: key joins, window assignment, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.session import settle


def attach_scores(docs: DataFrame, scores: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Scores (or labels, or clusters) joined to their rows by key, not by position."""
    return docs.join(scores, key, how)


def assign_windows(
    facts: DataFrame, windows: DataFrame, ts: str, start: str = "start_ts", end: str = "end_ts",
    bounds: str = "half_open", bucket_seconds: int = 3600,
) -> DataFrame:
    """Every fact with every window its time falls in.

    Time is cut into buckets; a window is listed once per bucket it touches, and the
    join is an equi-join on the bucket with the exact bounds as a residual test. The
    listed windows are written first, so Spark knows their size: under its threshold it
    broadcasts them and the facts are not shuffled; above it both sides are sorted by
    bucket, and AQE splits a bucket that holds too many facts.
    """
    if bounds not in ("half_open", "closed"):
        raise ValueError(f"bounds must be 'half_open' or 'closed', not {bounds!r}")

    def bucket(c):
        return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(bucket_seconds)).cast("long")

    listed = windows.filter(F.col(start) <= F.col(end)).withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(end))))
    )
    listed = settle(listed, "windows")
    t = F.col(ts)
    upper = t <= F.col(end) if bounds == "closed" else t < F.col(end)
    keyed = facts.withColumn("_bucket", bucket(t))
    return keyed.join(listed, (keyed["_bucket"] == listed["_bucket"]) & (t >= F.col(start)) & upper).drop("_bucket")


def missing_from(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys with no actual row.

    Actual keys are made distinct first: that is combined in each task, so a key with
    very many rows does not travel row by row.
    """
    return expected.select(*keys).distinct().join(actual.select(*keys).distinct(), list(keys), "left_anti")


def missing_ranges(df: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """(keys..., first, last): the stretches of days on which a key has no rows, between the
    first and the last day of the whole frame.

    Gaps between the days that are there; keys are never multiplied by days. Rows without a
    day, and keys that have no others, do not count.
    """
    known = df.filter(F.col(day).isNotNull())
    low, high = known.agg(F.min(day), F.max(day)).first()
    kind = df.schema[day].dataType
    days = known.select(*keys, day).distinct()
    order = Window.partitionBy(*keys).orderBy(day)
    before = F.coalesce(F.lag(day).over(order), F.date_sub(F.lit(low).cast(kind), 1))
    gap = F.struct(F.date_add(before, 1).alias("first"), F.date_sub(day, 1).alias("last"))
    end = F.struct(F.date_add(day, 1).alias("first"), F.lit(high).cast(kind).alias("last"))
    at_end = F.lead(day).over(order).isNull()
    ranges = days.withColumn("_gap", gap).withColumn("_end", F.when(at_end, end))
    every = ranges.select(*keys, F.explode(F.array("_gap", "_end")).alias("_r")).select(*keys, "_r.*")
    return every.filter(F.col("first") <= F.col("last"))


def missing_days(df: DataFrame, keys: Sequence[str], day: str = "date") -> DataFrame:
    """The days of ``missing_ranges``, one row each."""
    return missing_ranges(df, keys, day).select(*keys, F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias(day))


def present_in(rows: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys occur in the other frame."""
    return rows.join(actual.select(*keys).distinct(), list(keys), "left_semi")


def expected_outputs(days: DataFrame, sets: Sequence[str], name: str = "output") -> DataFrame:
    """One row per given row and named output. The names are a parameter, so this is an
    explode of a constant array, not a cross join."""
    return days.withColumn(name, F.explode(F.array(*[F.lit(s) for s in sets])))


def presence(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys with a flag for whether any actual row exists."""
    seen = actual.select(*keys).distinct().withColumn("present", F.lit(True))
    return expected.join(seen, list(keys), "left").withColumn("present", F.coalesce("present", F.lit(False)))
