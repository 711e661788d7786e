"""Aggregates over labels and daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.catalog.registry import cents, query, round6, sql_mean6, table
from moodlake.operators import joins, series, summary
from moodlake.operators.dedup import union_batches
from moodlake.plans import daily
from moodlake.sources.readers import daily_last_value

_MEASURES = f"""
    COUNT(*) AS n_rows, COUNT(*) FILTER (event_type = 'error') AS n_label,
    round(COUNT(*) FILTER (event_type = 'error') / COUNT(*), 6) AS share,
    {sql_mean6("sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'error')", "COUNT(value) FILTER (event_type = 'error')")} AS mean_score,
    {sql_mean6("coalesce(sum(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'error'), 0)", "COUNT(*)")} AS intensity
"""
# Every seventh event has lost its score, the label it keeps.
_SCORED = "(SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN value END AS value) FROM events)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("value", F.when(F.col("event_id") % 7 != 0, cents("value")))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            round6(c).alias(c) if c in ("mean_score", "intensity")
            else F.round(c, 6).alias(c) if t == "double" else F.col(c).cast("string").alias(c) if t == "date" else F.col(c)
            for c, t in df.dtypes
        ]
    )


@query(
    """
    SELECT 'scored' AS denominator, source, COUNT(l.toxic) AS n_rows, COUNT(*) FILTER (l.toxic = 1) AS n_label,
           round(coalesce(COUNT(*) FILTER (l.toxic = 1) / nullif(COUNT(l.toxic), 0), 0), 6) AS share
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source
    UNION ALL
    SELECT 'all', source, COUNT(*), COUNT(*) FILTER (l.toxic = 1), round(COUNT(*) FILTER (l.toxic = 1) / COUNT(*), 6)
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source
    """
)
def label_share_denominators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents only partly labelled: the two denominators differ."""
    flag = F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, "clean")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = joins.attach_scores(docs, table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("label", flag)
    both = [
        summary.label_summary(labelled, "label", "quality", "toxic", ["source"], d).withColumn("denominator", F.lit(d))
        for d in ("scored", "all")
    ]
    return _rounded(union_batches(*both).select("denominator", "source", "n_rows", "n_label", "share"))


@query(
    f"""
    SELECT source, round(coalesce(avg(quality) FILTER (toxic = 1), 0), 6) AS mean_score
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source
    """
)
def group_label_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").withColumn("label", F.when(F.col("toxic") == 1, "Toxic").otherwise("clean"))
    joined = joins.attach_scores(docs, labels, "doc_id", "left")
    return _rounded(summary.group_label_mean(joined, "source", "label", "quality", "toxic"))


@query(f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_MEASURES} FROM {_SCORED} GROUP BY 1")
def label_share_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(summary.label_by_period(_scored(spark, sf_dir), "ts", "event_type", "value", "ERROR"))


@query(f"SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, {_MEASURES} FROM {_SCORED} GROUP BY 1")
def label_share_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(summary.label_by_period(_scored(spark, sf_dir), "ts", "event_type", "value", "error", period="week"))


@query(
    """
    SELECT source, COUNT(*) AS total, COUNT(*) FILTER (length(t) > 0) AS success, COUNT(*) FILTER (t IS NULL) AS failed,
           COUNT(*) FILTER (length(t) = 0) AS empty, CAST(coalesce(sum(length(t)), 0) AS BIGINT) AS total_chars,
           round(coalesce(sum(length(t)) / nullif(COUNT(*) FILTER (length(t) > 0), 0), 0), 6) AS mean_chars
    FROM (SELECT source, CASE lang WHEN 'fr' THEN NULL WHEN 'es' THEN '' ELSE text END AS t FROM documents) GROUP BY source
    """
)
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One language stands for failed downloads, another for empty ones."""
    got = F.when(F.col("lang") == "fr", F.lit(None)).when(F.col("lang") == "es", "").otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("source", got.alias("text"))
    return _rounded(summary.ingest_stats(docs, "text", ["source"]))


@query("SELECT source, lang, COUNT(*) AS n_rows FROM documents GROUP BY source, lang")
def group_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.group_counts(table(spark, sf_dir, "documents"), ["source", "lang"])


_DAYS = """
    days AS (
      SELECT unnest(generate_series((SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) FROM events),
                                    (SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) FROM events), INTERVAL 1 DAY)) AS d)
"""


@query(
    f"""
    WITH {_DAYS}, seen AS (SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS n FROM events GROUP BY user_id)
    SELECT user_id, round(n / (SELECT COUNT(*) FROM days), 6) AS rate FROM seen
    """
)
def completeness_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the calendar's days on which a user has events."""
    actual = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date"))
    return _rounded(summary.day_completeness(actual, ["user_id"]))


# Each user's last value per kind of event and day, and a calendar from the first day of
# each such series to its last.
_LAST = """
    obs AS (
      SELECT user_id, event_type, date, value FROM (
        SELECT user_id, event_type, CAST(ts AS DATE) AS date, value,
               row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1),
    span AS (SELECT user_id, event_type, min(date) AS lo, max(date) AS hi FROM obs GROUP BY ALL),
    grid AS (
      SELECT g.user_id, g.event_type, CAST(g.d AS DATE) AS date, o.value
      FROM (SELECT user_id, event_type, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM span) g
      LEFT JOIN obs o ON o.user_id = g.user_id AND o.event_type = g.event_type AND o.date = CAST(g.d AS DATE))
"""
_KEYS = ["user_id", "event_type"]


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_last_value(table(spark, sf_dir, "events"), "ts", "value", _KEYS, tie="event_id")


@query(
    f"""
    WITH {_LAST}
    SELECT user_id, event_type, CAST(date AS VARCHAR) AS date, coalesce(last_value(value IGNORE NULLS) OVER w, 20.0) AS filled,
           CAST(date - last_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER w AS INTEGER) AS age_days
    FROM grid WINDOW w AS (PARTITION BY user_id, event_type ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)
    """
)
def asof_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = series.as_of(_observed(spark, sf_dir), keys=_KEYS, max_age=7, default=20.0)
    return _rounded(filled.select(*_KEYS, "date", "filled", "age_days"))


@query(
    f"""
    WITH {_LAST}
    SELECT user_id, event_type, CAST(date AS VARCHAR) AS date, last_value(value IGNORE NULLS) OVER w AS filled
    FROM grid WINDOW w AS (PARTITION BY user_id, event_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """
)
def asof_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = series.as_of(_observed(spark, sf_dir), keys=_KEYS, max_age=None)
    return _rounded(filled.select(*_KEYS, "date", "filled"))


@query(
    f"""
    WITH {_LAST}, last AS (SELECT max(hi) AS hi FROM span),
    days AS (
      SELECT user_id, event_type, date, lead(date) OVER (PARTITION BY user_id, event_type ORDER BY date) AS next FROM obs),
    source AS (
      SELECT user_id, event_type, date AS source_day, CAST(unnest(generate_series(CAST(date AS TIMESTAMP),
        CAST(least(coalesce(next - 1, hi), date + 6) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM days, last)
    SELECT s.user_id, s.event_type, CAST(s.date AS VARCHAR) AS date, CAST(s.source_day AS VARCHAR) AS source_day, e.event_id
    FROM source s JOIN events e ON e.user_id = s.user_id AND e.event_type = s.event_type AND CAST(e.ts AS DATE) = s.source_day
    """
)
def carry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without events of a user and kind take those of the last day that has some."""
    rows = table(spark, sf_dir, "events").select(*_KEYS, "event_id", F.to_date("ts").alias("date"))
    return _rounded(series.carry_rows(rows, keys=_KEYS).select(*_KEYS, "date", "source_day", "event_id"))


def _daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", F.to_date("ts").alias("date")).agg(F.avg("value").alias("value"))


_MEAN = "daily AS (SELECT event_type, CAST(ts AS DATE) AS date, avg(value) AS value FROM events GROUP BY 1, 2)"


@query(
    f"""
    WITH {_MEAN} SELECT event_type, CAST(date AS VARCHAR) AS date,
    round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) AS zscore
    FROM daily WINDOW w AS (PARTITION BY event_type)
    """
)
def zscore_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(series.zscore(_daily_mean(spark, sf_dir), keys=["event_type"]).drop("value"))


@query(
    f"""
    WITH {_MEAN} SELECT event_type, CAST(date AS VARCHAR) AS date,
    round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) AS zscore
    FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
    """
)
def zscore_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = series.zscore_rolling(_daily_mean(spark, sf_dir), keys=["event_type"], days=7, ddof=0)
    return _rounded(rolled.drop("value"))


@query(
    f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, {_MEASURES} FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1
    UNION ALL SELECT '2024-01-31', 0, 0, 0, 0, 0
    """
)
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole month in one job; its last day has no events."""
    events = table(spark, sf_dir, "events").withColumn("value", cents("value"))
    return _rounded(daily.backfill(events, "2024-01-01", "2024-01-31", "event_type", "value", "error"))
