"""Sinks: partitioned files, the insert-only upsert, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlake.operators.dedup import keep_first
from moodlake.session import scratch_path


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by output folder, so that a folder gets few files; AQE
    splits a folder that holds too much for one task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_json(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """UTF-8 JSON records, one per line, optionally in partition folders. Overwriting
    replaces only the partitions present in ``df``."""
    writer = balanced(df, partition_by).write.mode(mode).option("ignoreNullFields", False)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.json(path)


def write_csv(df: DataFrame, path: str, decimals: int | None = 3, mode: str = "overwrite") -> None:
    """CSV with a header; doubles rounded for print."""
    if decimals is not None:
        df = df.select(*[F.round(c, decimals).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_summary_and_detail(summary: DataFrame, detail: DataFrame, path: str) -> None:
    """The daily summary and the rows behind it, as two CSV datasets."""
    write_csv(summary, f"{path}/summary")
    write_csv(detail, f"{path}/detail")


def write_embeddings(df: DataFrame, path: str, key: str, vector: str, mode: str = "overwrite") -> None:
    """Key and float vector as Parquet."""
    df.select(key, F.col(vector).cast("array<float>").alias(vector)).write.mode(mode).parquet(path)


def write_texts(df: DataFrame, path: str, partition_by: Sequence[str] = ("date", "group"), mode: str = "append") -> None:
    """Cleaned text corpus with its key, partitioned. Replaces only partitions present
    in ``df`` when ``mode`` is 'overwrite'."""
    balanced(df, partition_by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def split_failures(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without an error, rows with one)."""
    return df.filter(F.col(error).isNull()).drop(error), df.filter(F.col(error).isNotNull())


def write_dead_letters(dead: DataFrame, path: str) -> bool:
    """Append failed records as JSON; write nothing at all when there are none."""
    if dead.isEmpty():
        return False
    dead.write.mode("append").json(path)
    return True


def upsert_keep_existing(
    new: DataFrame, path: str, key: str, order: Sequence[Column | str], date: str = "date", rewrite: bool = False
) -> None:
    """Add records whose key the date's partition does not hold yet; the first one wins.

    Stored rows always win, so nothing stored has to change: the default reads the key
    column of the touched dates, drops known keys and appends the rest. ``rewrite=True``
    writes the touched dates anew instead, which also compacts their files. It goes
    through a staged copy, because the source of the rewrite is also its target.
    """
    spark = new.sparkSession
    fresh = keep_first(new, [date, key], order)
    stored = None
    try:
        stored = spark.read.option("mergeSchema", rewrite).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    if stored is not None:
        # Spark prunes the partitions by the dates of the batch when it runs the join.
        stored = stored.withColumn(date, F.col(date).cast(new.schema[date].dataType))
        stored = stored.join(new.select(date).distinct(), date, "left_semi")
        fresh = fresh.join(stored.select(date, key), [date, key], "left_anti")
    if stored is None or not rewrite:
        balanced(fresh, [date]).write.mode("append").partitionBy(date).parquet(path)
        return
    stage = scratch_path(spark, "upsert")
    # Columns that only the stored rows or only the new ones have are kept, with nulls.
    both = stored.unionByName(fresh, allowMissingColumns=True)
    balanced(both, [date]).write.partitionBy(date).parquet(stage)
    (
        balanced(spark.read.schema(both.schema).parquet(stage), [date])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date)
        .parquet(path)
    )
