"""Windows, slots and dates at their edges."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moodlake.functions import times as tm
from moodlake.operators import joins

EDGES = [
    "2024-03-05 12:29:59.999999", "2024-03-05 12:30:00", "2024-03-05 12:30:00.000001",
    "2024-03-05 18:59:59.999999", "2024-03-05 19:00:00", "2024-03-05 19:00:00.000001",
]


def edges(spark, kind="timestamp_ntz"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "id int, t string").select(
        "id", F.col("t").cast(kind).alias("ts")
    )


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("bounds,ids", [("half_open", [1, 2, 3]), ("closed", [1, 2, 3, 4])])
def test_within(spark, kind, bounds, ids):
    kept = tm.within(edges(spark, kind), "ts", "2024-03-05 12:30:00", datetime(2024, 3, 5, 19), bounds)
    assert sorted(r.id for r in kept.collect()) == ids


def test_within_rejects_other_bounds(spark):
    with pytest.raises(ValueError):
        tm.within(edges(spark), "ts", "2024-03-05", "2024-03-06", "open")


def runs(spark, *times):
    return spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("run_ts"))


@pytest.mark.parametrize("bounds,pairs", [("half_open", 6), ("closed", 7)])
def test_shared_boundary_belongs_to_one_window_unless_closed(spark, bounds, pairs):
    windows = tm.run_windows(runs(spark, "2024-03-05 12:45:00", "2024-03-05 20:00:00", "2024-03-06 12:45:00"), "run_ts")
    got = joins.assign_windows(edges(spark), windows, "ts", bounds=bounds).select("id", "run_id").collect()
    assert len(got) == pairs + (1 if bounds == "closed" else 0)
    by_id = {i: sorted(r.run_id for r in got if r.id == i) for i in range(6)}
    assert by_id[0] == ["2024-03-05-am"] and by_id[2] == ["2024-03-05-pm"] and by_id[5] == ["2024-03-06-am"]
    both = bounds == "closed"
    assert by_id[1] == (["2024-03-05-am", "2024-03-05-pm"] if both else ["2024-03-05-pm"])
    assert by_id[4] == (["2024-03-05-pm", "2024-03-06-am"] if both else ["2024-03-06-am"])


def test_post_and_news_schedules(spark):
    both = runs(spark, "2024-03-05 12:59:59", "2024-03-05 13:00:00")
    post = tm.run_windows(both, "run_ts").orderBy("run_ts").collect()
    assert [(r.start_ts, r.end_ts) for r in post] == [
        (datetime(2024, 3, 4, 19), datetime(2024, 3, 5, 12, 30)),
        (datetime(2024, 3, 5, 12, 30), datetime(2024, 3, 5, 19)),
    ]
    news = tm.run_windows(runs(spark, "2024-03-05 13:59:00", "2024-03-05 14:00:00"), "run_ts", tm.NEWS_SCHEDULE)
    assert [(r.start_ts, r.end_ts) for r in news.orderBy("run_ts").collect()] == [
        (datetime(2024, 3, 4, 18), datetime(2024, 3, 5, 12, 59)),
        (datetime(2024, 3, 5, 11, 30), datetime(2024, 3, 5, 13)),
    ]


def test_windows_of_any_length_are_found(spark):
    windows = spark.createDataFrame([("w", "2024-03-01 00:00:00", "2024-03-09 00:00:00")], "run_id string, a string, b string").select(
        "run_id", F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts")
    )
    assert joins.assign_windows(edges(spark), windows, "ts").count() == 6


def test_slot_grid_includes_both_ends_and_zeroes_seconds(spark):
    spans = spark.createDataFrame(
        [("a", "2024-03-05 10:00:42", "2024-03-05 10:30:00"), ("b", "2024-03-05 10:05:00", "2024-03-05 10:05:00"), ("c", "2024-03-06", "2024-03-05")],
        "k string, lo string, hi string",
    ).select("k", F.col("lo").cast("timestamp").alias("lo"), F.col("hi").cast("timestamp").alias("hi"))
    got = sorted((r.k, r.stamp) for r in tm.slot_grid(spans, "lo", "hi").collect())
    assert got == [
        ("a", "20240305100000"), ("a", "20240305101500"), ("a", "20240305103000"), ("b", "20240305100500"),
    ]


def test_dates_that_are_not_dates_become_null(spark):
    paths = ["p/2024-03-05/x.csv", "p/date=2024-03-05/x", "p/2024-02-30/x", "p/latest/x", "2024-03-05", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = [r.d for r in df.orderBy("i").select("i", tm.date_in_path(F.col("p")).alias("d")).collect()]
    assert got == [date(2024, 3, 5), date(2024, 3, 5), None, None, None, None]
    stamps = spark.createDataFrame([("20240305101112",), ("2024",), (None,)], "s string")
    assert [r.t is None for r in stamps.select(tm.stamp_to_timestamp(F.col("s")).alias("t")).collect()] == [False, True, True]
    assert stamps.filter(tm.on_day(F.col("s"), "2024-03-05")).count() == 1


def test_epoch(spark):
    df = spark.createDataFrame([(1709632872,), (None,)], "e long").select(tm.epoch_to_iso(F.col("e")).alias("iso"))
    assert [r.iso for r in df.collect()] == ["2024-03-05T10:01:12", None]


def test_calendar(spark):
    rows = [("a", date(2024, 1, 1)), ("a", date(2024, 1, 3)), ("b", date(2024, 1, 5))]
    df = spark.createDataFrame(rows, "k string, date date")
    assert tm.calendar(df).count() == 5
    assert tm.calendar(df, keys=["k"]).count() == 3 + 1
    assert tm.calendar(df, keys=["k"], shared=True).count() == 10
    assert tm.calendar(df.filter("false")).count() == 0
