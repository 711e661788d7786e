"""Plans at scale: what is pruned, pushed down, and never planned."""

import pytest
from pyspark.sql import functions as F

from moodlake.catalog import QUERIES
from moodlake.functions import times as tm
from moodlake.operators import joins
from moodlake.operators.dedup import keep_first_text
from moodlake.plans.daily import sentiment_by_group

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"kmeans_best_k", "kmeans_assign"}))
def test_no_query_plans_a_nested_loop_or_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_filter_reaches_the_scan(spark):
    plan = plan_of(tm.within(events(spark), "ts", "2024-01-05", "2024-01-06").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_day_of_a_stamp_is_a_pushed_prefix(spark, tmp_path):
    path = str(tmp_path / "stamped")
    events(spark).select("event_id", F.date_format("ts", tm.STAMP).alias("stamp")).write.parquet(path)
    plan = plan_of(spark.read.parquet(path).filter(tm.on_day(F.col("stamp"), "2024-01-10")))
    assert "StringStartsWith(stamp,20240110)" in plan


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = plan_of(keep_first_text(docs, "text", ["doc_id"]).select("doc_id")).splitlines()
    at = {w: i for i, line in enumerate(lines) for w in ("Final", "Exchange hash", "Partial") if w in line}
    assert at["Final"] < at["Exchange hash"] < at["Partial"]
    assert "text" not in next(line for line in lines if "Exchange hash" in line)


def test_flagship_does_not_shuffle_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    summary = sentiment_by_group(docs, "doc_id", "text", "source", ["good"], ["bad"])
    plan = plan_of(summary)
    sort = next(line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line)
    below_limit = plan[plan.index(sort):]
    project = next(line for line in below_limit.splitlines() if "Project [" in line)
    assert "sha2" in project and "text#" not in project.split("sha2")[0]


def test_windows_join_on_a_bucket(spark):
    e = events(spark)
    windows = tm.run_windows(e.select(F.col("ts").alias("run_ts")), "run_ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.assign_windows(e, windows, "ts"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [_bucket" in plan


def test_catalog_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["dedup_keep_first"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan
    plan = plan_of(QUERIES["label_share_daily"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in plan


@pytest.mark.parametrize("name", ["label_share_mean", "score_lexicon", "tokenize_counts", "html_to_text", "embed_hashing"])
def test_registered_text_queries_do_not_shuffle_texts(spark, name):
    assert "RoundRobinPartitioning" not in plan_of(QUERIES[name](spark, SF))


def test_as_of_scans_its_input_once(spark):
    plan = plan_of(QUERIES["asof_observed"](spark, SF))
    assert plan.count("FileScan parquet") == 1
