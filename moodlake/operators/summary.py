"""Label shares, means and counts. Each is one partial-then-final aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_is(label: str, target: str) -> Column:
    """Case-insensitive label test; a null label is false."""
    return F.coalesce(F.lower(F.col(label)) == F.lit(target.lower()), F.lit(False))


def label_measures(label: str, score: str, target: str, denominator: str = "scored") -> list[Column]:
    """Aggregates: n_rows, n_label, share, mean_score, intensity.

    ``denominator`` is the row count the share divides by: ``'scored'`` (rows with a
    label) or ``'all'``. The mean is over the rows under the label that have a score.
    Intensity is the mean over the denominator of the score where the label holds and 0
    elsewhere. All are 0 when there is nothing to divide by. A decimal score gives exact
    decimals.
    """
    if denominator not in ("scored", "all"):
        raise ValueError(f"denominator must be 'scored' or 'all', not {denominator!r}")
    hit = label_is(label, target)
    n = F.count(F.col(label)) if denominator == "scored" else F.count(F.lit(1))
    n_label = F.count_if(hit)
    held = F.when(hit, F.col(score))

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0))

    return [
        n.alias("n_rows"),
        n_label.alias("n_label"),
        ratio(n_label, n).alias("share"),
        F.coalesce(F.avg(held), F.lit(0)).alias("mean_score"),
        ratio(F.sum(held), n).alias("intensity"),
    ]


def label_summary(
    df: DataFrame, label: str, score: str, target: str, by: Sequence[Column | str] = (), denominator: str = "scored"
) -> DataFrame:
    """Share of a label and mean score under it, overall or by group."""
    return df.groupBy(*by).agg(*label_measures(label, score, target, denominator))


def label_by_period(
    df: DataFrame, ts: str, label: str, score: str, target: str, period: str = "day",
    by: Sequence[str] = (), denominator: str = "scored",
) -> DataFrame:
    """The summary per day, or per week starting on Monday."""
    start = F.to_date(F.date_trunc(period, F.col(ts))) if period != "day" else F.to_date(ts)
    return label_summary(df, label, score, target, [start.alias(period), *by], denominator)


def group_label_mean(df: DataFrame, group: str, label: str, score: str, target: str) -> DataFrame:
    """Mean score under a label per group; 0 for a group that has none."""
    mean = F.avg(F.when(label_is(label, target), F.col(score)))
    return df.groupBy(group).agg(F.coalesce(mean, F.lit(0)).alias("mean_score"))


def ingest_stats(df: DataFrame, text: str, by: Sequence[str] = (), empty_as_failed: bool = False) -> DataFrame:
    """Totals of one load: rows, ok, failed (null), empty, characters, mean characters."""
    size = F.char_length(F.col(text))
    failed = size.isNull() | (size == 0) if empty_as_failed else size.isNull()
    ok = F.count_if(size > 0)
    chars = F.coalesce(F.sum(size), F.lit(0)).cast("long")
    return df.groupBy(*by).agg(
        F.count("*").alias("total"),
        ok.alias("success"),
        F.count_if(failed).alias("failed"),
        (F.lit(0).cast("long") if empty_as_failed else F.count_if(size == 0)).alias("empty"),
        chars.alias("total_chars"),
        F.coalesce(F.try_divide(chars, ok), F.lit(0.0)).alias("mean_chars"),
    )


def group_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def completeness_rate(presence: DataFrame, present: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of expected outputs that exist."""
    return presence.groupBy(*by).agg(F.avg(F.col(present).cast("double")).alias("rate"))


def day_completeness(df: DataFrame, by: Sequence[str], day: str = "date") -> DataFrame:
    """Share of the days from the first to the last of the whole frame on which a key has rows.

    Counts distinct days; keys and days are never multiplied.
    """
    ends = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    n_days = ends.select(F.date_diff("hi", "lo") + 1).scalar()
    return df.groupBy(*by).agg((F.count_distinct(day) / n_days).alias("rate"))
