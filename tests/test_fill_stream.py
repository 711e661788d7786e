"""A daily series filled as a stream, against the batch form."""

import pytest
from pyspark.sql import functions as F

from moodlake.operators.series import as_of
from moodlake.session import scratch_path
from moodlake.streaming import streams
from moodlake.streaming.fill import fill_stream

SCHEMA = "k string, date date, value double"
RUNS = [
    [("a", 3, 1.0), ("a", 1, 0.5), ("b", 2, 9.0), (None, 2, 4.0), ("a", 2, None), ("a", 3, 0.25)],
    [("b", 12, 8.0), ("a", 5, 2.0)],
    [("a", 11, 3.0), ("c", 14, 7.0), ("c", 14, 7.0)],
    [("z", 40, 1.0)],
]


@pytest.mark.parametrize("ages", [{"max_age": None}, {"max_age": 2}, {"max_age": 2, "default": 20.0}, {"max_age": 0, "default": 1.5}])
def test_as_the_batch_form(spark, ages):
    source, path, state = (scratch_path(spark, f"fill-test-{x}") for x in ("source", "out", "state"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n") - 1)
    for i, run in enumerate(RUNS):
        rows = spark.createDataFrame(run, "k string, n int, value double").select("k", day.alias("date"), "value")
        rows.write.parquet(f"{source}/run={i}")
        stream = fill_stream(streams.read_files(spark, f"{source}/*", rows.schema), ["k"], "date", "value", "10 days", **ages)
        got = streams.run_to_table(stream, path, checkpoint=state).collect()
    every = spark.read.schema(SCHEMA).parquet(*[f"{source}/run={i}" for i in range(len(RUNS))])
    first = every.groupBy("k", "date").agg(F.max("value").alias("value"))
    until = F.lit("2024-01-29").cast("date")
    want = as_of(first.filter("k is null or k <> 'z'"), keys=["k"], until=until, **ages).filter(F.col("date") <= until).collect()
    assert len(got) == len(set(got)) and sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("buckets", [1, 3, 2048])
def test_keys_of_a_bucket_share_a_call(spark, buckets):
    source, path, state = (scratch_path(spark, f"fill-keys-{x}") for x in ("source", "out", "state"))
    made = spark.range(0, 60).select(
        F.when(F.col("id") % 20 != 7, F.col("id") % 20 + (1 << 60)).alias("k"), F.timestamp_micros(F.col("id") % 20 + 1).alias("t"),
        F.concat(F.lit('a"\\'), F.col("id") % 20).alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / 20).cast("int") * 4).alias("date"),
        F.col("id").cast("double").alias("value"),
    )
    made.write.parquet(source)
    stream = fill_stream(streams.read_files(spark, source, made.schema), ["k", "t", "s"], "date", "value", "1 day", max_age=2, buckets=buckets)
    got = streams.run_to_table(stream, path, checkpoint=state).collect()
    want = as_of(made, keys=["k", "t", "s"], until=F.lit("2024-01-07").cast("date"), max_age=2)
    want = want.filter(F.col("date") <= "2024-01-07").select("k", "t", "s", "date", "filled", "age_days").collect()
    assert len(got) == 20 * 6 and sorted(map(str, got)) == sorted(map(str, want))


def test_calls_do_not_grow_with_the_keys(spark):
    """As many groups as buckets, however many keys there are."""
    source = scratch_path(spark, "fill-many")
    made = spark.range(500).select(F.col("id").alias("k"), F.lit("2024-01-01").cast("date").alias("date"), F.lit(1.0).alias("value"))
    made.write.parquet(source)
    stream = fill_stream(streams.read_files(spark, source, made.schema), ["k"], "date", "value", "1 day", buckets=4)
    query = stream.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "fill-many-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
