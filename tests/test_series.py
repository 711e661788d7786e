"""Carry-forward and z-scores."""

from datetime import date, timedelta

import pytest

from moodlake.operators import series
from moodlake.sources.readers import daily_last_value

D0 = date(2024, 1, 1)


def grid(spark, values, key="k"):
    rows = [(key, D0 + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, date date, value double")


def filled(df, **kw):
    rows = series.carry_forward(df, keys=["k"], default=20.0, **kw).orderBy("date").collect()
    return [(r.filled, r.age_days) for r in rows]


def test_gaps_of_one_seven_and_eight_days(spark):
    got = filled(grid(spark, [None, 5.0, None, 6.0] + [None] * 8 + [7.0]))
    assert got[:4] == [(20.0, None), (5.0, 0), (5.0, 1), (6.0, 0)]
    assert got[4:11] == [(6.0, i) for i in range(1, 8)]
    assert got[11:] == [(20.0, None), (7.0, 0)]


def test_chained_never_expires(spark):
    got = filled(grid(spark, [None, 6.0] + [None] * 20), mode="chained")
    assert got[0] == (20.0, None) and all(v == 6.0 for v, _ in got[1:])


def test_no_lookback_is_the_default_at_once(spark):
    assert filled(grid(spark, [5.0, None]), max_age=0) == [(5.0, 0), (20.0, None)]


def test_observed_is_never_older_than_the_limit(spark):
    values = [1.0 if i % 11 == 0 else None for i in range(60)]
    assert all(age is None or age <= 3 for _, age in filled(grid(spark, values), max_age=3))


def test_rows_are_carried_over_short_gaps_only(spark):
    rows = [("a", D0, 1), ("a", D0, 2), ("a", D0 + timedelta(days=9), 3), ("b", D0 + timedelta(days=8), 4)]
    df = spark.createDataFrame(rows, "k string, date date, id int")
    got = sorted(((r.date - D0).days, r.id) for r in series.carry_rows(df, keys=["k"], max_age=6).collect())
    assert got == sorted([(d, i) for d in range(7) for i in (1, 2)] + [(9, 3), (8, 4), (9, 4)])
    chained = series.carry_rows(df.filter("k = 'a'"), max_age=6, mode="chained")
    assert chained.count() == 9 * 2 + 1


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        series.carry_forward(grid(spark, [1.0]), mode="guess")


def test_zscore(spark):
    got = [r.zscore for r in series.zscore(grid(spark, [1.0, 2.0, 3.0]), keys=["k"]).orderBy("date").collect()]
    assert got == pytest.approx([-1, 0, 1])
    assert all(r.zscore is None for r in series.zscore(grid(spark, [4.0] * 5), keys=["k"]).collect())
    assert all(r.zscore is None for r in series.zscore_rolling(grid(spark, [4.0] * 5), keys=["k"]).collect())


def test_rolling_counts_calendar_days(spark):
    df = grid(spark, [1.0, 3.0]).union(spark.createDataFrame([("k", D0 + timedelta(days=30), 9.0)], "k string, date date, value double"))
    got = [r.zscore for r in series.zscore_rolling(df, keys=["k"], days=7, ddof=0).orderBy("date").collect()]
    assert got == [None, pytest.approx(1.0), None]


def test_latest_and_daily_last(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1.0, 1), ("2024-01-01 12:00:00", 2.0, 2), ("2024-01-01 12:00:00", 3.0, 3), ("2024-01-02 00:00:00", 4.0, 4)], "t string, value double, id int")
    df = df.selectExpr("CAST(t AS TIMESTAMP_NTZ) AS ts", "value", "id")
    assert series.latest(df, "ts").first().value == 4.0
    got = daily_last_value(df, "ts", "value", tie="id").orderBy("date").collect()
    assert [r.value for r in got] == [3.0, 4.0]
