"""Structured Streaming forms of the collection and summary jobs.

The stream's checkpoint is the "last collected" marker; the watermark is the lag that
late feeds are given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from moodlake.operators.summary import label_measures
from moodlake.session import scratch_path
from moodlake.sources.writers import upsert_keep_existing


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files as they arrive under a path or glob."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def with_event_time(stream: DataFrame, ts: str, lag: str) -> DataFrame:
    """Event-time column as a zoned timestamp (a watermark rejects one without zone)
    and a watermark ``lag`` behind the latest row seen."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lag)


def dedup_stream(stream: DataFrame, key: str | Sequence[str], ts: str, lag: str) -> DataFrame:
    """First arrival of each key; keys older than the watermark leave the state."""
    keys = [key] if isinstance(key, str) else list(key)
    return with_event_time(stream, ts, lag).dropDuplicatesWithinWatermark(keys)


def slot_counts(stream: DataFrame, ts: str, lag: str, slot: str = "15 minutes") -> DataFrame:
    """Rows per slot. The window column itself is the grouping key: grouping by its
    start would lose the watermark and never free the state."""
    counted = with_event_time(stream, ts, lag).groupBy(F.window(ts, slot)).agg(F.count("*").alias("n_rows"))
    return counted.select(F.col("window.start").alias("slot"), "n_rows")


SLOT_STATE = "slot long, salt int, n_rows long, record string"


def slots_and_late(
    stream: DataFrame, ts: str, lag: str, keep: Sequence[str], slot_minutes: int = 15, salts: int = 8
) -> DataFrame:
    """Rows per slot with late rows reported: ``(slot, salt, n_rows, record)``, in update mode.

    A row on time counts: its slot and salt get a row with the new count and no record. A row
    whose slot had ended by the watermark is given back as it is, a JSON record of ``keep``
    without a count. The count of a slot is kept until the watermark passes its end, when a
    timer frees it. Slots are dealt over ``salts`` keys, so that one busy slot is not one task.
    """
    size = slot_minutes * 60_000_000
    event = with_event_time(stream, ts, lag)
    record = F.to_json(F.struct(*keep), {"ignoreNullFields": "false"})
    micros = F.unix_micros(F.col(ts))
    start = micros - F.pmod(micros, F.lit(size))
    rows = event.filter(F.col(ts).isNotNull()).select(start.alias("slot"), record.alias("record"))
    # Spark takes rows away unseen whose event time lies behind the watermark. The time that it is
    # shown here is never late, so that the function sees all rows; its timers are not touched.
    shown = F.lit("2250-01-01").cast("timestamp").alias("shown", metadata={"spark.watermarkDelayMs": 0})
    rows = rows.select("slot", F.pmod(F.xxhash64("record"), F.lit(salts)).cast("int").alias("salt"), "record", shown)

    def count(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        slot, salt = key
        slot, salt = int(slot), int(salt)
        end = (slot + size) // 1000
        if state.hasTimedOut:
            state.remove()
            return
        if end <= state.getCurrentWatermarkMs():
            for frame in frames:
                yield pd.DataFrame({"slot": slot, "salt": salt, "n_rows": pd.array([None] * len(frame), "Int64"), "record": frame["record"]})
            return
        n = (state.get[0] if state.exists else 0) + sum(len(frame) for frame in frames)
        state.update((int(n),))
        state.setTimeoutTimestamp(end)
        yield pd.DataFrame({"slot": [slot], "salt": [salt], "n_rows": pd.array([n], "Int64"), "record": pd.Series([None], dtype=object)})

    grouped = rows.groupBy("slot", "salt")
    return grouped.applyInPandasWithState(count, SLOT_STATE, "n long", "update", GroupStateTimeout.EventTimeTimeout)


def run_slots_and_late(stream: DataFrame, path: str, checkpoint: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Run ``slots_and_late`` to the end of what is there and read what is stored: ``(slot,
    n_rows)`` and the dead letters ``(slot, record, error)``. Together they are all rows."""
    spark = stream.sparkSession
    run_to_end(stream, lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch:012d}"), "update", checkpoint)
    stored = spark.read.schema(f"{SLOT_STATE}, batch string").option("basePath", path).parquet(path)
    latest = stored.filter("n_rows is not null").groupBy("slot", "salt").agg(F.max_by("n_rows", "batch").alias("n_rows"))
    start = F.timestamp_micros("slot").alias("slot")
    counts = latest.groupBy("slot").agg(F.sum("n_rows").alias("n_rows")).select(start, "n_rows")
    late = stored.filter("record is not null").select(start, "record", F.lit("behind the watermark").alias("error"))
    return counts, late


def label_stream(
    stream: DataFrame, ts: str, lag: str, label: str, score: str, target: str, denominator: str = "scored",
    period: str = "1 day",
) -> DataFrame:
    """Running share of a label and mean score under it, per period."""
    grouped = with_event_time(stream, ts, lag).groupBy(F.window(ts, period))
    summed = grouped.agg(*label_measures(label, score, target, denominator))
    return summed.select(F.col("window.start").alias("period_start"), *summed.columns[1:])


def run_to_end(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], output_mode: str = "append",
    checkpoint: str | None = None,
) -> None:
    """Process everything available, batch by batch, then stop."""
    query: StreamingQuery = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "stream"))
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()


def run_to_table(stream: DataFrame, path: str, checkpoint: str | None = None) -> DataFrame:
    """Run to the end in append mode into a Parquet folder and read it. The file sink's own
    log makes each batch count once."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str | None = None) -> DataFrame:
    """Run an aggregation to the end in update mode; read the latest row of each key.

    Each batch writes the rows it changed to a folder of its own, so a batch that runs again
    replaces only itself and no reader's files are taken away. Windows older than the
    watermark leave the state and are not written again.
    """
    spark = stream.sparkSession
    run_to_end(stream, lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch:012d}"), "update", checkpoint)
    stored = spark.read.schema(f"{_ddl(stream)}, batch string").option("basePath", path).parquet(path)
    latest = stored.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("row"))
    return latest.select("row.*")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def upsert_stream(
    stream: DataFrame, path: str, key: str, order: Sequence[Column | str], date: str = "date",
    checkpoint: str | None = None,
) -> None:
    """Add each batch to the stored dates, keeping records already there. Running a
    batch again adds nothing, so a restart is harmless."""

    def store(batch: DataFrame, _: int) -> None:
        held = batch.persist()
        try:
            upsert_keep_existing(held, path, key, order, date)
        finally:
            held.unpersist()

    run_to_end(stream, store, checkpoint=checkpoint)
