"""Registration and table access for the catalog."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.session import bound_batches, use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        key = name or fn.__name__

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(bound_batches(use_utc(spark)), sf_dir.rstrip("/"))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round6(c: Column | str) -> Column:
    """Six decimals, as a double; a decimal is rounded before it becomes one."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6).cast("double")


def cents(c: str) -> Column:
    """A column of two decimals as an exact decimal, so that sums and means are exact."""
    return F.col(c).cast("decimal(14,2)")


def sql_mean6(cents_sum: str, n: str) -> str:
    """Sum of hundredths over n, rounded half up to six decimals in whole numbers; 0 for n = 0."""
    return f"coalesce(((2 * CAST(({cents_sum}) AS HUGEINT) * 10000 + ({n})) // nullif(2 * ({n}), 0)) / 1e6, 0)"


def sql_exact_mean6(score: str, condition: str, n: str) -> str:
    """The sum of the scores, to nine decimals each, where the condition holds, over n; rounded
    half up to six decimals in whole numbers; 0 for n = 0."""
    billionths = f"CAST(coalesce(sum(CAST(round({score} * 1e9) AS BIGINT)) FILTER ({condition}), 0) AS HUGEINT)"
    return f"coalesce(((2 * {billionths} + 1000 * ({n})) // nullif(2000 * ({n}), 0)) / 1e6, 0)"


def sql_list(words) -> str:
    """Words as a SQL list of string literals."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)
