"""Backfill of the days whose rows have changed, and of no others."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.plans.daily import parse_range
from moodlake.session import settle
from moodlake.sources.writers import balanced

_DIGEST = "date date, n long, mark decimal(38,0)"


def _runs(days: list[date]) -> list[tuple[date, date]]:
    """Consecutive days as (first, last)."""
    runs: list[tuple[date, date]] = []
    for day in sorted(days):
        if runs and day == runs[-1][1] + timedelta(1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def _within(ts: str, kind: T.DataType, first: date, last: date) -> Column:
    """The column is left bare, so that the bounds reach the scan."""
    return (F.col(ts) >= F.lit(str(first)).cast(kind)) & (F.col(ts) < F.date_add(F.lit(last), 1).cast(kind))


def day_digests(rows: DataFrame, ts: str, columns: list[str], version: str = "") -> DataFrame:
    """``(date, n, mark)``: the rows of each day and the sum of their hashes over ``columns``.

    The sum does not depend on the order of rows, and a repeated row counts each time. One row
    per task and day is shuffled. Nulls are told apart from empty texts and from nulls of other
    columns; another ``version`` gives other marks.
    """
    said = [F.struct(F.lit(i), F.col(c).isNull(), F.col(c)) for i, c in enumerate([ts, *columns])]
    mark = F.sum(F.xxhash64(F.lit(version), *said).cast("decimal(38,0)")).cast("decimal(38,0)")
    return rows.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias("n"), mark.alias("mark"))


def _digests(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_DIGEST).parquet(f"{path}/digests")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _DIGEST)


def refresh_changed(
    rows: DataFrame, path: str, start: str, end: str, compute: Callable[[DataFrame], DataFrame], columns: list[str],
    ts: str = "ts", version: str = "",
) -> list[date]:
    """Bring the stored result of an inclusive range of days up to date; the days written anew.

    ``compute`` makes from the rows of some days a result with a ``date`` column, any number of
    rows a day. It sees only the rows of days whose digest over ``columns`` differs from the
    one kept beside the result, or that have none. Name in ``version`` what else the result depends on,
    such as a word list. The result of those days is replaced first and the digests after it, so a
    run that breaks off is made good by the next one. A day that has lost all its rows is masked by its
    digest. What reaches the driver is at most one date a day of the range.
    """
    spark = rows.sparkSession
    first, last = parse_range(start, end)
    kind = rows.schema[ts].dataType
    inside = rows.filter(_within(ts, kind, first, last))
    kept = _digests(spark, path).filter(F.col("date").between(F.lit(first), F.lit(last)))
    old = kept.select("date", F.col("n").alias("_n"), F.col("mark").alias("_mark"))
    now = day_digests(inside, ts, columns, version)
    both = now.join(old, "date", "full").withColumn("n", F.coalesce("n", F.lit(0)))
    same = F.col("n").eqNullSafe(F.col("_n")) & F.col("mark").eqNullSafe(F.col("_mark"))
    changed = settle(both.filter(~same).select("date", "n", "mark"), "changed-days")
    days = [r.date for r in changed.select("date").collect()]
    if not days:
        return []
    wanted = reduce(Column.__or__, [_within(ts, kind, a, b) for a, b in _runs(days)])
    result = compute(inside.filter(wanted))
    _replace(result, f"{path}/result")
    _replace(changed, f"{path}/digests")
    return sorted(days)


def _replace(df: DataFrame, path: str) -> None:
    writer = balanced(df, ["date"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)


def read_refreshed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored result, without days that have lost their rows."""
    result = spark.read.schema(schema).parquet(f"{path}/result")
    return result.join(_digests(spark, path).filter("n > 0").select("date"), "date", "left_semi").select(*schema.names)
