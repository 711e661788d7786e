"""Backfill of changed days, and feed files of several widths."""

from datetime import date

from pyspark.sql import functions as F

from moodlake.plans.changed import read_refreshed, refresh_changed
from moodlake.session import scratch_path
from moodlake.sources import readers


def _frame(spark, rows):
    return spark.createDataFrame(rows, "ts string, v string").withColumn("ts", F.col("ts").cast("timestamp"))


def test_only_changed_days_are_computed(spark):
    path, seen = scratch_path(spark, "changed-test"), []

    def compute(rows):
        days = rows.select(F.to_date("ts").alias("date"), "v")
        seen.append(sorted({r.date.day for r in days.collect()}))
        return days.groupBy("date").agg(F.count("*").alias("n"), F.max("v").alias("top"))

    def run(rows, **more):
        days = refresh_changed(_frame(spark, rows), path, "2024-01-01", "2024-01-09", compute, ["v"], **more)
        stored = read_refreshed(spark, path, _schema).collect()
        return [d.day for d in days], sorted((r.date.day, r.n, r.top) for r in stored)

    _schema = spark.createDataFrame([], "date date, n long, top string").schema
    rows = [("2024-01-01 05:00:00", "a"), ("2024-01-02 01:00:00", None), ("2024-01-03 00:00:00", "b"), ("2024-02-01 00:00:00", "z")]
    assert run(rows) == ([1, 2, 3], [(1, 1, "a"), (2, 1, None), (3, 1, "b")])
    assert run(rows[::-1]) == ([], [(1, 1, "a"), (2, 1, None), (3, 1, "b")])
    # An empty text is not null; a repeated row counts; a day may come, go and come back.
    rows[1] = ("2024-01-02 01:00:00", "")
    assert run(rows) == ([2], [(1, 1, "a"), (2, 1, ""), (3, 1, "b")])
    assert run([*rows, rows[0], rows[0]]) == ([1], [(1, 3, "a"), (2, 1, ""), (3, 1, "b")])
    assert run([rows[0], rows[0], rows[0], rows[1]]) == ([3], [(1, 3, "a"), (2, 1, "")])
    assert run([rows[0], rows[0], rows[0], rows[1]]) == ([], [(1, 3, "a"), (2, 1, "")])
    assert run([*rows, ("2024-01-09 23:59:59", "end")]) == ([1, 3, 9], [(1, 1, "a"), (2, 1, ""), (3, 1, "b"), (9, 1, "end")])
    assert run([*rows, ("2024-01-09 23:59:59", "end")], version="2")[0] == [1, 2, 3, 9]
    assert seen == [[1, 2, 3], [2], [1], [], [1, 3, 9], [1, 2, 3, 9]]
    assert run([])[1] == []


def test_days_reach_the_scan(spark, tmp_path):
    rows = _frame(spark, [(f"2024-01-0{d} 00:00:00", "a") for d in range(1, 8)])
    rows.write.parquet(str(tmp_path / "rows"))
    plans = []

    def compute(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.select(F.to_date("ts").alias("date"), "v")

    path = scratch_path(spark, "changed-plan")
    read = spark.read.parquet(str(tmp_path / "rows"))
    assert refresh_changed(read, path, "2024-01-02", "2024-01-03", compute, ["v"]) == [date(2024, 1, 2), date(2024, 1, 3)]
    assert "GreaterThanOrEqual(ts" in plans[0] and "LessThan(ts" in plans[0]


def test_width_belongs_to_the_file(spark, tmp_path):
    made = {
        "full.tsv": "1\t2\t3\n4\t5\n",
        "short.tsv": '6\tNA\n"7\t7"\t8\n9\n',
        "narrow.tsv": "x\ny\n",
        "wide.tsv": 'a\t"b\tb ""q"""\t\td\ne\tf\tg\nh\n',
    }
    for name, text in made.items():
        (tmp_path / name).write_text(text)
    named, unknown, dead = readers.scan_feed_files(spark, str(tmp_path), ["k", "v", "w"])
    assert sorted(tuple(r) for r in named.collect()) == [
        ("1", "2", "3"), ("4", "5", None), ("6", None, None), ("7\t7", "8", None), ("9", None, None),
    ]
    got = [(r.file.rsplit("/", 1)[1], r.width, [r.fields.get(f"Column_{i}", "-") for i in range(4)]) for r in unknown.collect()]
    assert sorted(got, key=str) == [
        ("narrow.tsv", 1, ["x", "-", "-", "-"]),
        ("narrow.tsv", 1, ["y", "-", "-", "-"]),
        ("wide.tsv", 4, ["a", 'b\tb "q"', None, "d"]),
        ("wide.tsv", 4, ["e", "f", "g", "-"]),
        ("wide.tsv", 4, ["h", "-", "-", "-"]),
    ]
    assert sorted((r.file.rsplit("/", 1)[1], r.error, r.n_rows) for r in dead.collect()) == [
        ("narrow.tsv", "expected 3 columns, found 1", 2), ("wide.tsv", "expected 3 columns, found 4", 3),
    ]


def test_groups_may_be_a_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a:b"), (2, "c"), (3, "d")], "id int, g string")
    rows.write.partitionBy("g").parquet(str(tmp_path / "t"))
    asked = spark.createDataFrame([("a:b",), ("c",), ("c",), ("none",), (None,)], "g string")
    found, counts = readers.scan_groups(spark, str(tmp_path / "t"), rows.schema, asked, "g")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a:b"), (2, "c")]
    assert sorted(tuple(r) for r in counts.collect()) == [("a:b", 1), ("c", 1), ("none", 0)]
