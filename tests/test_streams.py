"""Streams give the batch result; late rows are dropped after the watermark."""

from pyspark.sql import functions as F

from moodlake.operators import summary
from moodlake.streaming import streams

EVENT = "id int, ts timestamp, label string, score double"


def land(spark, tmp_path, *batches):
    schema = spark.createDataFrame([], EVENT).schema
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "id int, t string, label string, score double")
        df.select("id", F.col("t").cast("timestamp").alias("ts"), "label", "score").coalesce(1).write.parquet(f"{tmp_path}/in/b{i}")
    return streams.read_files(spark, f"{tmp_path}/in/*", schema, files_per_batch=1)


DAY = [
    [(1, "2024-01-01 10:00:00", "neg", 0.5), (2, "2024-01-01 10:14:59", "POS", 0.9)],
    [(2, "2024-01-01 10:14:59", "POS", 0.9), (3, "2024-01-01 10:15:00", "NEG", 0.7)],
]


def test_duplicates_in_a_later_batch_are_dropped(spark, tmp_path):
    fresh = streams.dedup_stream(land(spark, tmp_path, *DAY), "id", "ts", "1 day")
    assert sorted(r.id for r in streams.run_to_table(fresh, f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_late_rows_after_the_watermark_are_dropped(spark, tmp_path):
    batches = [
        [(1, "2024-01-01 10:00:00", "neg", 0.5)],
        [(2, "2024-01-01 15:00:00", "neg", 0.5)],
        [(3, "2024-01-01 14:30:00", "neg", 0.5)],
        [(4, "2024-01-01 11:00:00", "neg", 0.5)],
    ]
    fresh = streams.dedup_stream(land(spark, tmp_path, *batches), "id", "ts", "1 hour")
    assert sorted(r.id for r in streams.run_to_table(fresh, f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_slots_and_labels_equal_the_batch_result(spark, tmp_path):
    stream = land(spark, tmp_path, *DAY)
    slots = streams.run_updates(streams.slot_counts(stream, "ts", "1 day"), f"{tmp_path}/slots", ["slot"])
    assert {str(r.slot)[11:16]: r.n_rows for r in slots.collect()} == {"10:00": 3, "10:15": 1}
    daily = streams.run_updates(streams.label_stream(stream, "ts", "1 day", "label", "score", "neg"), f"{tmp_path}/daily", ["period_start"]).first()
    batch = summary.label_by_period(spark.read.parquet(f"{tmp_path}/in/*"), "ts", "label", "score", "neg").first()
    assert (daily.n_rows, daily.n_label, daily.share, daily.mean_score) == (batch.n_rows, batch.n_label, batch.share, batch.mean_score)


def test_a_restart_continues_from_the_checkpoint(spark, tmp_path):
    stream = land(spark, tmp_path, *DAY)
    for _ in range(2):
        seen = []
        streams.run_to_end(stream, lambda b, i: seen.append(b.count()), checkpoint=f"{tmp_path}/ck")
    assert seen == []


def test_upsert_stream_keeps_the_first_values(spark, tmp_path):
    changed = [DAY[0], [(2, "2024-01-01 10:14:59", "POS", 0.1), (3, "2024-01-01 10:15:00", "NEG", 0.7)]]
    stream = land(spark, tmp_path, *changed).withColumn("date", F.to_date("ts"))
    streams.upsert_stream(stream, f"{tmp_path}/store", "id", ["ts"])
    stored = spark.read.schema(stream.schema).parquet(f"{tmp_path}/store").collect()
    assert {r.id: r.score for r in stored} == {1: 0.5, 2: 0.9, 3: 0.7}
