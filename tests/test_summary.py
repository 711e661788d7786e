"""Label measures, counts, scores and their empty cases."""

import random

import pytest

from moodlake.operators import joins, summary
from moodlake.operators.scoring import score_model, score_words
from moodlake.plans.daily import backfill, parse_range
from moodlake.sources.writers import split_failures

ROWS = [
    ("a", "Negative", 0.9), ("a", "NEGATIVE", 0.7), ("a", "negative", 0.5), ("a", "positive", 0.8), ("a", None, None),
    ("b", "neutral", 0.6), ("b", None, None),
]


def scored(spark, rows=ROWS):
    return spark.createDataFrame(rows, "g string, label string, score double")


@pytest.mark.parametrize("denominator,n,share", [("scored", 5, 3 / 5), ("all", 7, 3 / 7)])
def test_denominators(spark, denominator, n, share):
    row = summary.label_summary(scored(spark), "label", "score", "negative", denominator=denominator).first()
    assert row.n_rows == n and row.n_label == 3
    assert row.share == pytest.approx(share) and row.mean_score == pytest.approx(0.7)
    assert row.intensity == pytest.approx(row.share * row.mean_score)


def test_empty_input_gives_zeros(spark):
    row = summary.label_summary(scored(spark).filter("false"), "label", "score", "negative").first()
    assert tuple(row) == (0, 0, 0.0, 0.0, 0.0)


def test_unknown_denominator(spark):
    with pytest.raises(ValueError):
        summary.label_summary(scored(spark), "label", "score", "negative", denominator="some")


def test_group_without_the_label_is_zero(spark):
    got = {r.g: r.mean_score for r in summary.group_label_mean(scored(spark), "g", "label", "score", "negative").collect()}
    assert got["a"] == pytest.approx(0.7) and got["b"] == 0.0


def test_intensity_is_share_times_mean_on_random_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abcd"), rng.choice(["x", "y", "X", None]), rng.random()) for _ in range(500)]
    for r in summary.label_summary(scored(spark, rows), "label", "score", "x", ["g"], "all").collect():
        assert r.intensity == pytest.approx(r.share * r.mean_score)


def test_ingest_stats_separates_empty_from_failed(spark):
    df = spark.createDataFrame([("abc",), ("",), (None,), ("de",)], "t string")
    row = summary.ingest_stats(df, "t").first()
    assert (row.total, row.success, row.failed, row.empty, row.total_chars, row.mean_chars) == (4, 2, 1, 1, 5, 2.5)
    row = summary.ingest_stats(df, "t", empty_as_failed=True).first()
    assert (row.failed, row.empty) == (2, 0)
    row = summary.ingest_stats(df.filter("false"), "t").first()
    assert (row.total, row.total_chars, row.mean_chars) == (0, 0, 0.0)


def test_score_words(spark):
    df = spark.createDataFrame([(1, "bad bad good"), (2, "Good!"), (3, "good bad"), (4, ""), (5, None), (6, "badly")], "id int, t string")
    got = {r.id: (r.label, r.score) for r in score_words(df, "t", ["good"], ["bad"]).collect()}
    assert got == {
        1: ("negative", 3 / 5), 2: ("positive", 2 / 3), 3: ("neutral", 0.5), 4: ("neutral", 0.5), 5: (None, None),
        6: ("neutral", 0.5),
    }
    one_sided = {r.id: r.label for r in score_words(df, "t", [], ["bad"]).collect()}
    assert one_sided[1] == "negative" and one_sided[2] == "neutral"


def test_one_bad_text_costs_one_row(spark):
    def _raises_on_x():
        def score(texts):
            if any("x" in t for t in texts):
                raise RuntimeError("no x")
            return [("ok", len(t)) for t in texts]

        return score

    df = spark.createDataFrame([(1, "aa"), (2, "xx"), (3, ""), (4, None), (5, "bbb")], "id int, t string").coalesce(1)
    out = score_model(df, "t", _raises_on_x, ["id"])
    good, dead = split_failures(out)
    assert {r.id: r.score for r in good.collect()} == {1: 2.0, 3: None, 4: None, 5: 3.0}
    assert [(r.id, r.error) for r in dead.collect()] == [(2, "RuntimeError: no x")]
    assert score_model(df.filter("false"), "t", _raises_on_x, ["id"]).count() == 0


def test_wrong_number_of_scores_is_not_misassigned(spark):
    def _miscounts():
        return lambda texts: [("ok", 1.0)] * (1 if len(texts) > 1 else len(texts))

    df = spark.createDataFrame([(i, "t") for i in range(5)], "id int, t string").coalesce(1)
    assert score_model(df, "t", _miscounts, ["id"]).filter("label = 'ok'").count() == 5


def test_completeness_and_missing(spark):
    days = spark.createDataFrame([("d1",), ("d2",)], "day string")
    expected = joins.expected_outputs(days, ["news", "posts"])
    actual = spark.createDataFrame([("d1", "news"), ("d1", "news"), ("d2", "posts"), ("d1", "posts")], "day string, output string")
    keys = ["day", "output"]
    assert [tuple(r) for r in joins.missing_from(expected, actual, keys).collect()] == [("d2", "news")]
    rates = summary.completeness_rate(joins.presence(expected, actual, keys), "present", ["day"])
    assert {r.day: r.rate for r in rates.collect()} == {"d1": 1.0, "d2": 0.5}


def test_backfill_lists_every_day(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "x", 1.0), ("2024-01-03 23:59:59", "x", 2.0), ("2024-01-04 00:00:00", "x", 9.0)], "t string, label string, score double")
    df = df.selectExpr("CAST(t AS TIMESTAMP_NTZ) AS ts", "label", "score")
    got = backfill(df, "2024-01-01", "2024-01-03", "label", "score", "x").orderBy("date").collect()
    assert [(str(r.date), r.n_rows, r.mean_score) for r in got] == [("2024-01-01", 1, 1.0), ("2024-01-02", 0, 0.0), ("2024-01-03", 1, 2.0)]


@pytest.mark.parametrize("start,end", [("2024-01-02", "2024-01-01"), ("01/02/2024", "2024-01-03"), ("2024-02-30", "2024-03-01")])
def test_backfill_rejects_bad_ranges(start, end):
    with pytest.raises(ValueError):
        parse_range(start, end)


def test_a_labelled_row_without_a_score_does_not_pull_the_mean_down(spark):
    df = spark.createDataFrame([("g", "neg", 1.0), ("g", "neg", None), ("g", "pos", 0.2)], "g string, label string, score double")
    row = summary.label_summary(df, "label", "score", "neg").first()
    assert (row.n_label, row.mean_score) == (2, 1.0) and row.intensity == pytest.approx(1 / 3)
    assert summary.group_label_mean(df, "g", "label", "score", "neg").first().mean_score == 1.0
