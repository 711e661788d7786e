"""Streaming forms, run to the end of what is available."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.catalog.registry import cents, query, round6, sql_mean6, table
from moodlake.session import scratch_path, settle
from moodlake.sources.readers import daily_last_value
from moodlake.streaming import streams
from moodlake.streaming.fill import fill_stream

# Longer than any overlap of two collection runs below.
_LAG = "3 days"

# The values an event has in the first run that collects it.
_FIRST_SEEN = """
    WITH d AS (SELECT *, date_diff('day', CAST((SELECT min(ts) FROM events) AS DATE), CAST(ts AS DATE)) AS since FROM events),
    seen AS (
      SELECT event_id, event_type, ts,
             CASE WHEN since < 11 THEN value WHEN since < 21 THEN value + 1000 ELSE value + 2000 END AS value FROM d)
"""


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A glob, because the source takes a folder or a glob and the table may be one file.
    return streams.read_files(spark, f"{sf_dir}/events.parque[t]", schema)


def _overlapping_runs(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The whole table as three collection runs, each starting a day before the last one
    ended. A later run carries other values. Gives a stream over the landing folder each
    time one more run is there."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", F.to_date("ts").alias("date"))
    since = F.date_diff("ts", events.agg(F.min("ts")).scalar())
    path = scratch_path(spark, "runs")
    for i, (low, high) in enumerate(((0, 11), (10, 21), (20, 1_000_000))):
        run = events.filter((since >= low) & (since < high)).withColumn("value", F.col("value") + 1000 * i)
        run.write.parquet(f"{path}/run={i}")
        yield streams.read_files(spark, f"{path}/*", events.schema)


@query(f"{_FIRST_SEEN} SELECT event_id, event_type, CAST(ts AS VARCHAR) AS ts, value FROM seen")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming job, started again after each run; its checkpoint is the marker of
    what has been collected."""
    path, checkpoint = scratch_path(spark, "stream-dedup"), scratch_path(spark, "stream-dedup-state")
    for stream in _overlapping_runs(spark, sf_dir):
        fresh = streams.dedup_stream(stream, "event_id", "ts", _LAG)
        stored = streams.run_to_table(fresh, path, checkpoint=checkpoint)
    return stored.select("event_id", "event_type", F.col("ts").cast("string").alias("ts"), "value")


@query("SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S') AS slot, COUNT(*) AS n_rows FROM events GROUP BY 1")
def stream_slot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = streams.slot_counts(_event_stream(spark, sf_dir), "ts", _LAG)
    stored = streams.run_updates(counts, scratch_path(spark, "stream-slots"), ["slot"])
    return stored.select(F.date_format("slot", "yyyyMMddHHmmss").alias("slot"), "n_rows")


@query(
    """
    WITH w AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM events WHERE event_id % 10 <> 0)
    SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S') AS slot, COUNT(*) AS n_rows
    FROM events, w WHERE event_id % 10 <> 0 OR time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE > mark GROUP BY 1
    """
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the events arrives after all others: rows behind the watermark are dropped,
    the others still join their slots."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    source, path, state = (scratch_path(spark, f"stream-late-{x}") for x in ("source", "slots", "state"))
    late = F.col("event_id") % 10 == 0
    for i, part in enumerate((events.filter(~late), events.filter(late))):
        part.write.parquet(f"{source}/run={i}")
        counts = streams.slot_counts(streams.read_files(spark, f"{source}/*", events.schema), "ts", _LAG)
        stored = streams.run_updates(counts, path, ["slot"], checkpoint=state)
    return stored.select(F.date_format("slot", "yyyyMMddHHmmss").alias("slot"), "n_rows")


@query(
    """
    WITH w AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM events WHERE event_id % 10 <> 0),
    e AS (SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS slot,
                 event_id % 10 <> 0 OR time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE > mark AS in_time FROM events, w)
    SELECT 'slot' AS part, strftime(slot, '%Y%m%d%H%M%S') AS slot, COUNT(*) AS n_rows, NULL AS event_id FROM e WHERE in_time GROUP BY slot
    UNION ALL SELECT 'late', strftime(slot, '%Y%m%d%H%M%S'), 1, event_id FROM e WHERE NOT in_time
    """
)
def stream_late_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two arrivals, with the rows behind the watermark as dead letters: all rows are
    either counted or reported."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    source, path, state = (scratch_path(spark, f"stream-reported-{x}") for x in ("source", "slots", "state"))
    late = F.col("event_id") % 10 == 0
    for i, part in enumerate((events.filter(~late), events.filter(late))):
        part.write.parquet(f"{source}/run={i}")
        found = streams.slots_and_late(streams.read_files(spark, f"{source}/*", events.schema), "ts", _LAG, ["event_id", "ts"], salts=2)
        counts, dead = streams.run_slots_and_late(found, path, checkpoint=state)
    slot = F.date_format("slot", "yyyyMMddHHmmss").alias("slot")
    counted = counts.select(F.lit("slot").alias("part"), slot, "n_rows", F.lit(None).cast("long").alias("event_id"))
    event = F.get_json_object("record", "$.event_id").cast("long").alias("event_id")
    return counted.unionByName(dead.select(F.lit("late").alias("part"), slot, F.lit(1).cast("long").alias("n_rows"), event))


@query(
    f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS n_rows, COUNT(*) FILTER (event_type = 'error') AS n_label,
           round(COUNT(*) FILTER (event_type = 'error') / COUNT(*), 6) AS share,
           {sql_mean6("sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'error')", "COUNT(value) FILTER (event_type = 'error')")} AS mean_score
    FROM events GROUP BY 1
    """
)
def stream_label_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = streams.label_stream(_event_stream(spark, sf_dir).withColumn("value", cents("value")), "ts", _LAG, "event_type", "value", "error")
    stored = streams.run_updates(running, scratch_path(spark, "stream-label"), ["period_start"])
    return stored.select(
        F.to_date("period_start").cast("string").alias("day"), "n_rows", "n_label",
        F.round("share", 6).alias("share"), round6("mean_score").alias("mean_score"),
    )


@query(f"{_FIRST_SEEN} SELECT event_id, value FROM seen")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs added to the stored days: a record keeps the values it was first stored with."""
    path, checkpoint = scratch_path(spark, "stream-upsert"), scratch_path(spark, "stream-upsert-state")
    for stream in _overlapping_runs(spark, sf_dir):
        streams.upsert_stream(stream, path, "event_id", ["value"], checkpoint=checkpoint)
    return spark.read.schema(stream.schema).parquet(path).select("event_id", "value")


@query(
    """
    WITH obs AS (
      SELECT user_id, date, value FROM (
        SELECT user_id, CAST(ts AS DATE) AS date, value,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
    span AS (SELECT user_id, min(date) AS lo, (SELECT max(date) FROM obs) - 2 AS hi FROM obs GROUP BY user_id),
    grid AS (
      SELECT g.user_id, CAST(g.d AS DATE) AS date, o.value
      FROM (SELECT user_id, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM span) g
      LEFT JOIN obs o ON o.user_id = g.user_id AND o.date = CAST(g.d AS DATE)),
    filled AS (
      SELECT *, last_value(value IGNORE NULLS) OVER w AS chained, last_value(value IGNORE NULLS) OVER s AS recent,
             CAST(date - last_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER w AS INTEGER) AS age
      FROM grid WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                       s AS (PARTITION BY user_id ORDER BY date RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW))
    SELECT 'chained' AS mode, user_id, CAST(date AS VARCHAR) AS date, round(chained, 6) AS filled, age AS age_days FROM filled
    UNION ALL SELECT 'observed', user_id, CAST(date AS VARCHAR), round(coalesce(recent, 20.0), 6), CASE WHEN age <= 2 THEN age END FROM filled
    """
)
def stream_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's daily values arrive in three runs; days are filled as the watermark passes them."""
    observed = settle(daily_last_value(table(spark, sf_dir, "events"), "ts", "value", ["user_id"], tie="event_id"), "observed")
    since = F.date_diff("date", observed.agg(F.min("date")).scalar())
    source, out = scratch_path(spark, "fill-source"), []
    paths = {mode: (scratch_path(spark, f"fill-{mode}"), scratch_path(spark, f"fill-{mode}-state")) for mode in ("chained", "observed")}
    for i, (low, high) in enumerate(((0, 11), (11, 21), (21, 1_000_000))):
        observed.filter((since >= low) & (since < high)).write.parquet(f"{source}/run={i}")
        for mode, (path, state) in paths.items():
            stream = streams.read_files(spark, f"{source}/*", observed.schema)
            ages = {"max_age": None} if mode == "chained" else {"max_age": 2, "default": 20.0}
            streams.run_to_table(fill_stream(stream, ["user_id"], "date", "value", "1 day", **ages), path, checkpoint=state)
    for mode, (path, _) in paths.items():
        stored = spark.read.schema("user_id bigint, date date, filled double, age_days int").parquet(path)
        out.append(stored.select(F.lit(mode).alias("mode"), "user_id", F.col("date").cast("string").alias("date"), F.round("filled", 6).alias("filled"), "age_days"))
    return out[0].unionByName(out[1])
