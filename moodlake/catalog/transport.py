"""Sources and sinks: write a whole table in the format, read it back."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.catalog.registry import query, table
from moodlake.functions.text import strip
from moodlake.operators.dedup import union_batches
from moodlake.operators.scoring import score_model
from moodlake.operators.summary import label_summary
from moodlake.session import scratch_path, settle
from moodlake.sources import json_ranges, readers, writers

_ROWS_PER_DOCUMENT = 1000
#: Far under Spark's own 128 MB, so that the test tables give many ranges too.
_RANGE_BYTES = 1 << 18
#: Documents of one array that is read in ranges, some 200 MB; more documents make more files.
_ARRAY_ROWS = 100_000


def _land_tsv(df: DataFrame, path: str) -> str:
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (
        text.write.option("sep", "\t").option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
def scan_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = _land_tsv(docs, scratch_path(spark, "tsv"))
    return readers.scan_tsv(spark, path, len(docs.columns), multi_line=True)[0].toDF(*docs.columns)


_EVENT_NAMES = ("event_id", "user_id", "event_type", "value", "props")


@query(
    """
    SELECT 'all' AS layout, CAST(event_id AS VARCHAR) AS event_id, event_type, props FROM events
    UNION ALL SELECT 'short', CAST(event_id AS VARCHAR), event_type, NULL FROM events
    UNION ALL SELECT 'other', CAST(event_id AS VARCHAR), NULL, NULL FROM events
    """
)
def name_by_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds of the whole table: all columns, one fewer, and an unknown width."""
    events = table(spark, sf_dir, "events")
    parts = []
    for layout, width in (("all", 5), ("short", 4), ("other", 3)):
        path = _land_tsv(events.select(*_EVENT_NAMES[:width]), scratch_path(spark, f"width-{layout}"))
        found = readers.tsv_width(spark, path)
        named = readers.name_by_width(readers.scan_tsv(spark, path, found)[0], _EVENT_NAMES)
        if "Column_0" in named.columns:
            named = named.withColumnRenamed("Column_0", "event_id").select("event_id")
        parts.append(named.withColumn("layout", F.lit(layout)))
    return union_batches(*parts).select("layout", "event_id", "event_type", "props")


@query(
    """
    SELECT 'ok' AS status, CAST(event_id AS VARCHAR) AS event_id, event_type, props, NULL AS error FROM events
    UNION ALL SELECT 'ok', CAST(event_id AS VARCHAR), event_type, NULL, NULL FROM events
    UNION ALL SELECT 'dead', CAST(event_id AS VARCHAR), NULL, NULL, 'expected 5 columns, found 3' FROM events
    """
)
def scan_feed_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three feeds in one scan, unknown widths routed to the dead letters."""
    events = table(spark, sf_dir, "events")
    paths = [
        _land_tsv(events.select(*_EVENT_NAMES[:width]), scratch_path(spark, f"feed-{width}")) for width in (5, 4, 3)
    ]
    rows, dead = readers.scan_feed(spark, paths, _EVENT_NAMES)
    ok = rows.select(F.lit("ok").alias("status"), "event_id", "event_type", "props")
    bad = dead.select(F.lit("dead").alias("status"), F.split_part("record", F.lit("\t"), F.lit(1)).alias("event_id"), "error")
    return union_batches(ok, bad).select("status", "event_id", "event_type", "props", "error")


@query(
    """
    SELECT 'named' AS part, CAST(event_id AS VARCHAR) AS event_id, event_type, props, NULL AS error, NULL AS n_rows FROM events
    UNION ALL SELECT 'named', CAST(event_id AS VARCHAR), event_type, NULL, NULL, NULL FROM events
    UNION ALL SELECT 'unknown', CAST(event_id AS VARCHAR), event_type, NULL, NULL, NULL FROM events
    UNION ALL SELECT 'dead', NULL, NULL, NULL, 'expected 5 columns, found 3', COUNT(*) FROM events
    """
)
def scan_feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three feeds in one folder and one call; the width belongs to the file."""
    events, root = table(spark, sf_dir, "events"), scratch_path(spark, "feed-files")
    for width in (5, 4, 3):
        _land_tsv(events.select(*_EVENT_NAMES[:width]), f"{root}/{width}")
    named, unknown, dead = readers.scan_feed_files(spark, f"{root}/*", _EVENT_NAMES)
    none = F.lit(None).cast("string")
    rows = named.select(F.lit("named").alias("part"), "event_id", "event_type", "props", none.alias("error"), F.lit(None).cast("long").alias("n_rows"))
    other = unknown.select(F.lit("unknown"), F.col("fields")["Column_0"], F.col("fields")["Column_2"], none, none, F.lit(None).cast("long"))
    per_width = dead.groupBy("error").agg(F.sum("n_rows").alias("n_rows"))
    return rows.union(other).union(per_width.select(F.lit("dead"), none, none, none, "error", "n_rows"))


@query("SELECT doc_id, text, CASE WHEN lang <> 'de' THEN lang END AS lang, source FROM documents")
def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of about a thousand records each, one JSON array per file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    schema = docs.schema
    n_files = max(1, -(-docs.count() // _ROWS_PER_DOCUMENT))
    record = F.struct("doc_id", "text", F.when(F.col("lang") == "de", "NaN").otherwise(F.col("lang")).alias("lang"), "source")
    path = scratch_path(spark, "json-array")
    (
        docs.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(n_files)).alias("part"))
        .agg(F.to_json(F.collect_list(record)).alias("value"))
        .write.partitionBy("part").text(path)
    )
    rows, _ = readers.scan_json_array(spark, f"{path}/*", schema, nan_columns=["lang"])
    return rows


def _land_arrays(records: DataFrame, path: str, rows: int = _ARRAY_ROWS) -> str:
    """JSON texts, the only column, as files of about ``rows`` records that are one array each.

    A task writes its array as it gets it and holds one batch.
    """

    def array(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        empty = True
        for frame in frames:
            lead = ["[" if empty and i == 0 else "," for i in range(len(frame))]
            empty = empty and not lead
            yield pd.DataFrame({"value": [a + v for a, v in zip(lead, frame.iloc[:, 0])]})
        yield pd.DataFrame({"value": ["[]" if empty else "]"]})

    n_files = max(1, -(-records.count() // rows))
    records.repartition(n_files).mapInPandas(array, "value string").write.text(path)
    return path


@query("SELECT doc_id, text, CASE WHEN lang <> 'de' THEN lang END AS lang, source FROM documents")
def scan_json_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in arrays of a hundred thousand, one array a file, each read in many ranges."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    record = F.to_json(F.struct("doc_id", "text", F.when(F.col("lang") == "de", "NaN").otherwise(F.col("lang")).alias("lang"), "source"))
    path = _land_arrays(docs.select(record), scratch_path(spark, "json-arrays"))
    rows, _ = json_ranges.scan_json_ranges(spark, path, docs.schema, nan_columns=["lang"], range_bytes=_RANGE_BYTES)
    return rows


@query("SELECT text, COUNT(*) AS n FROM documents GROUP BY text")
def scan_text_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of about a thousand documents each, one JSON array of strings per file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_files = max(1, -(-docs.count() // _ROWS_PER_DOCUMENT))
    path = scratch_path(spark, "text-array")
    (
        docs.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(n_files)).alias("part"))
        .agg(F.to_json(F.collect_list("text")).alias("value"))
        .write.partitionBy("part").text(path)
    )
    rows, _ = readers.scan_text_array(spark, f"{path}/*")
    return rows.groupBy("text").agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'error'")
def scan_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("date"), "event_type")
    path = scratch_path(spark, "partitioned")
    writers.balanced(events, ["date", "event_type"]).write.partitionBy("date", "event_type").parquet(path)
    found = readers.read_partition(spark, path, events.schema, event_type="error")
    absent = readers.read_partition(spark, path, events.schema, date="1999-01-01")
    return found.unionByName(absent).select("event_id", "user_id", "value")


def _sources(spark: SparkSession, docs: DataFrame, *more: str) -> DataFrame:
    """The groups to ask for, as a table: a caller would have one at hand."""
    asked = docs.select("source").distinct()
    for name in more:
        asked = asked.union(spark.range(1).select(F.lit(name)))
    return settle(asked, "asked-groups")


@query(
    """
    SELECT g.source, COUNT(d.doc_id) AS n_rows
    FROM (SELECT DISTINCT source FROM documents UNION ALL SELECT 'absent') g LEFT JOIN documents d USING (source)
    GROUP BY g.source
    """
)
def scan_groups_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "groups")
    writers.balanced(docs, ["source"]).write.partitionBy("source").parquet(path)
    _, counts = readers.scan_groups(spark, path, docs.schema, _sources(spark, docs, "absent"), "source")
    return counts


@query("SELECT doc_id, text, source FROM documents")
def scan_groups_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "groups")
    writers.balanced(docs, ["source"]).write.partitionBy("source").parquet(path)
    rows, _ = readers.scan_groups(spark, path, docs.schema, _sources(spark, docs), "source")
    return rows.select("doc_id", "text", "source")


@query(
    """
    SELECT event_type, CAST(date AS VARCHAR) AS date, value FROM (
      SELECT event_type, CAST(ts AS DATE) AS date, value,
             row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1
    """
)
def daily_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = readers.daily_last_value(table(spark, sf_dir, "events"), "ts", "value", ["event_type"], tie="event_id")
    return daily.select("event_type", F.col("date").cast("string").alias("date"), "value")


@query("SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events WHERE event_type <> 'signup'")
def available_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of dates, and one folder whose name is not a date."""
    day = F.when(F.col("event_type") == "signup", "undated").otherwise(F.to_date("ts").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", day.alias("date"))
    path = scratch_path(spark, "dates")
    writers.balanced(events, ["date"]).write.partitionBy("date").parquet(path)
    return readers.available_dates(spark, path).select(F.col("date").cast("string").alias("date"))


@query("SELECT event_id, CASE WHEN hour(ts) < 13 THEN value ELSE value + 1000 END AS value FROM events")
def upsert_keep_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A morning batch, then the whole table with other values, twice."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", F.to_date("ts").alias("date"))
    path = scratch_path(spark, "upsert-target")
    later = events.withColumn("value", F.col("value") + 1000)
    writers.upsert_keep_existing(events.filter(F.hour("ts") < 13), path, "event_id", ["ts"])
    writers.upsert_keep_existing(later, path, "event_id", ["ts"])
    writers.upsert_keep_existing(later, path, "event_id", ["ts"], rewrite=True)
    return spark.read.schema(events.schema).parquet(path).select("event_id", "value")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "json")
    writers.write_json(docs, path, ["lang"])
    return spark.read.schema(docs.schema).json(path).select(*docs.columns)


def _csv_pair(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    scored = events.select(F.to_date("ts").alias("date"), F.col("event_type").alias("label"), (F.col("value") / 1000).alias("score"), "event_id")
    summary = label_summary(scored, "label", "score", "error", ["date"])
    detail = scored.select("event_id", "label", "score")
    path = scratch_path(spark, "csv")
    writers.write_summary_and_detail(summary, detail, path)
    return path, summary, detail


@query("SELECT event_id, event_type AS label, round(value / 1000, 3) AS score FROM events")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _, detail = _csv_pair(spark, sf_dir)
    return spark.read.schema(detail.schema).option("header", True).option("escape", '"').csv(f"{path}/detail")


@query(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, COUNT(*) AS n_rows, COUNT(*) FILTER (event_type = 'error') AS n_label,
           round(COUNT(*) FILTER (event_type = 'error') / COUNT(*), 3) AS share
    FROM events GROUP BY 1
    """
)
def sink_csv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, summary, _ = _csv_pair(spark, sf_dir)
    back = spark.read.schema(summary.schema).option("header", True).csv(f"{path}/summary")
    return back.select(F.col("date").cast("string").alias("date"), "n_rows", "n_label", "share")


@query(
    """
    SELECT vec_id, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings
    """
)
def sink_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "embeddings")
    writers.write_embeddings(table(spark, sf_dir, "embeddings"), path, "vec_id", "embedding")
    back = spark.read.parquet(path)
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return back.select("vec_id", F.size("embedding").cast("long").alias("dims"), F.round(total, 6).alias("total"))


@query("SELECT doc_id, text, source FROM documents WHERE trim(text) <> ''")
def sink_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned corpus, written by group with its key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = scratch_path(spark, "texts")
    writers.write_texts(docs.filter(strip("text") != ""), path, ["source"])
    return spark.read.schema(docs.schema).parquet(path).select("doc_id", "text", "source")


def _fussy_scorer():
    def score(texts: list[str]) -> list[tuple[str, float]]:
        if any("###" in t for t in texts):
            raise ValueError("unreadable marker")
        return [("neutral", 0.5)] * len(texts)

    return score


_DEAD = T.StructType(
    [T.StructField("group", T.StringType()), T.StructField("id", T.LongType()), T.StructField("error", T.StringType())]
)


@query("SELECT source AS \"group\", doc_id AS id, 'ValueError: unreadable marker' AS error FROM documents WHERE contains(text, '###')")
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that raises on some texts: those rows alone are dead letters."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("group"), F.col("doc_id").alias("id"), "text")
    # Written first, so that the model runs once however often the result is split.
    scored = settle(score_model(docs, "text", _fussy_scorer, ["group", "id"]), "scored")
    _, dead = writers.split_failures(scored)
    path = scratch_path(spark, "dead")
    if not writers.write_dead_letters(dead.select("group", "id", "error"), path):
        return spark.createDataFrame([], _DEAD)
    return spark.read.schema(_DEAD).json(path)
