"""Clustering and representative texts against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlake.operators import clustering, representatives
from moodlake.operators.representatives import representative_texts, term_counts


def blobs(spark, n=60, centres=3, dims=4, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, i % centres, [float(x) for x in rng.normal(5 * (i % centres), 0.3, dims)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label int, embedding array<float>"), rows


def test_kmeans_finds_blobs_and_repeats(spark):
    df, rows = blobs(spark)
    model = clustering.fit_kmeans(df, 3, starts=3)
    got = {r.id: r.cluster for r in clustering.assign(model, df).collect()}
    assert len(got) == 60 and len({(got[i], label) for i, label, _ in rows}) == 3
    again = clustering.fit_kmeans(df, 3, starts=3)
    assert {r.id: r.cluster for r in clustering.assign(again, df).collect()} == got


def test_best_of_starts_is_the_cheapest(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=6)]) for i in range(80)], "id long, embedding array<float>")
    costs = [clustering.fit_kmeans(df, 5, starts=1, seed=s).cost for s in (42, 43, 44)]
    best = clustering.fit_kmeans(df, 5, starts=3, seed=42)
    assert best.cost == pytest.approx(min(costs))
    assert best.sizes.sum() == 80


def test_silhouette_of_a_fit_is_the_measure_of_its_clusters(spark):
    df, _ = blobs(spark, n=40, centres=3)
    best = clustering.best_k(df, [2, 3], starts=2)
    assigned = clustering.assign(best.model, df)
    assert best.scores[best.k] == pytest.approx(clustering.silhouette_squared(assigned, "cluster"))
    odd = spark.createDataFrame([(1, None), (2, [0.0] * 4)], "id long, embedding array<float>")
    assert [r.cluster is None for r in clustering.assign(best.model, odd).orderBy("id").collect()] == [True, False]


def test_best_k(spark):
    df, _ = blobs(spark, centres=4)
    best = clustering.best_k(df, range(3, 7), starts=3)
    assert best.k == 4 and best.scores[4] == max(best.scores.values()) and sorted(best.scores) == [3, 4, 5, 6]
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(8)], "id long, embedding array<float>")
    assert clustering.best_k(same, range(3, 5), starts=1).k == 3


def brute_silhouette(rows, power=1):
    x, labels = np.array([r[2] for r in rows], dtype=np.float32).astype(float), np.array([r[1] for r in rows])
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = {}
    for i, r in enumerate(rows):
        own = labels == labels[i]
        others = [gap[i, labels == c].mean() for c in set(labels.tolist()) - {labels[i]}]
        if own.sum() == 1 or not others:
            out[r[0]] = 0.0
            continue
        a, b = gap[i, own].sum() / (own.sum() - 1), min(others)
        out[r[0]] = 0.0 if max(a, b) == 0 else (b - a) / max(a, b)
    return out


def test_silhouette_squared(spark):
    df, rows = blobs(spark, n=40)
    squared = brute_silhouette(rows, 2)
    assert clustering.silhouette_squared(df, "label") == pytest.approx(sum(squared.values()) / len(squared))


STOP = ("the", "of")


def brute_representatives(docs, top_n):
    words = {d: Counter(w for w in re.findall(r"\w{2,}", t.lower()) if w not in STOP) for d, _, t in docs}
    out = []
    for c in sorted({c for _, c, _ in docs}):
        ids = [d for d, k, _ in docs if k == c]
        df = Counter(w for d in ids for w in words[d])
        score = {}
        for d in ids:
            w = [n * (math.log((1 + len(ids)) / (1 + df[t])) + 1) for t, n in words[d].items()]
            score[d] = sum(w) / math.sqrt(sum(x * x for x in w)) if w else 0.0
        order = sorted(ids, key=lambda d: (-round(score[d], 9), d))
        order = order[:top_n] if df else order[:1]
        out += [(c, i + 1, d, round(score[d], 6)) for i, d in enumerate(order)]
    return out


def documents():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "common"]
    docs = [(i, "big" if i % 3 else "small", " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)) + ["common"])) for i in range(90)]
    docs += [(100, "one", "single text here"), (101, "stop", "the of"), (102, "stop", "of THE a"), (103, "mixed", "the"), (104, "mixed", "real words"), (105, "tie", "alpha beta"), (106, "tie", "beta alpha")]
    return docs


@pytest.mark.parametrize("hot_share", [0, 20, 10_000, 10**9])
def test_representatives_for_any_split_of_hot_and_cold_terms(spark, monkeypatch, hot_share):
    monkeypatch.setattr(representatives, "HOT_SHARE", hot_share)
    docs = documents()
    df = spark.createDataFrame(docs, "doc long, cluster string, text string")
    got = representative_texts(df, "doc", "cluster", "text", 5, STOP)
    rows = sorted((r.cluster, r.rank, r.doc, round(r.score, 6)) for r in got.collect())
    assert rows == brute_representatives(docs, 5)
    texts = {d: t for d, _, t in docs}
    assert all(texts[r.doc] == r.text for r in got.collect())


def test_rows_of_hot_terms_are_not_shuffled_before_they_are_summed(spark):
    df = spark.createDataFrame(documents(), "doc long, cluster string, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = representatives.with_document_frequency(term_counts(df, "doc", "text", ["cluster"]), "doc", "cluster")
        plan = joined.groupBy("doc").sum("tf")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    union = next(i for i, line in enumerate(lines) if "Union" in line)
    rare = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert sum("SortMergeJoin" in line for line in lines) == 1 and "LeftAnti" in plan
    hot = next(line for line in lines[union:rare] if "BroadcastHashJoin" in line)
    assert "Inner" in hot and not any("Exchange hash" in line for line in lines[union : lines.index(hot)])


def test_term_counts(spark):
    df = spark.createDataFrame([(1, "b a1 b a1 a1 cc"), (2, ""), (3, None), (4, "zz")], "doc long, text string")
    df = df.withColumn("text", F.regexp_replace("text", r"\bb\b", "bb"))
    got = {(r.doc, r.term): r.tf for r in term_counts(df, "doc", "text").collect()}
    assert got == {(1, "a1"): 3, (1, "bb"): 2, (1, "cc"): 1, (4, "zz"): 1}
    assert "Exchange" not in term_counts(df, "doc", "text")._jdf.queryExecution().executedPlan().toString()


def test_report_lists_empty_clusters(spark):
    df = spark.createDataFrame([(1, 0, "x", "word " * 40), (2, 0, "y", "other"), (3, 2, "x", "text")], "doc long, cluster int, grp string, text string")
    got = {r.cluster: r for r in clustering.cluster_report(df, "doc", "cluster", "grp", "text", n_clusters=4).collect()}
    assert {c: r["size"] for c, r in got.items()} == {0: 2, 1: 0, 2: 1, 3: 0}
    assert sum(r.percentage for r in got.values()) == pytest.approx(100)
    assert got[1].representative == "" and got[0].group_distribution == {"x": 1, "y": 1}
    assert all(len(r.representative) <= 100 for r in got.values())


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "bb aa aa"), (3, "!"), (4, "cc")], "id int, t string")
    got = {r.id: r.embedding for r in clustering.embed_hashing(df, "t", dims=64).collect()}
    assert got[1] == got[2] and sum(x * x for x in got[1]) == pytest.approx(1, abs=1e-6)
    assert sorted(x for x in got[1] if x) == pytest.approx([1 / math.sqrt(5), 2 / math.sqrt(5)])
    assert not any(got[3]) and len(got[4]) == 64


def test_model_embedding_batches(spark):
    def make():
        def predict(texts):
            assert len(texts) <= 4
            return np.array([[len(t), len(texts)] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "id int, t string").coalesce(1)
    got = {r.id: r.embedding[0] for r in clustering.embed_model(df, "t", make, batch=4).collect()}
    assert got == {i: float(i) for i in range(10)}


def test_empty_partitions(spark):
    rows = [(i, [float(i % 2) * 9, 0.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(16, "id")
    fit = clustering.fit_kmeans(df, 2, starts=1)
    assert sorted(fit.sizes.tolist()) == [2, 2]


def test_terms_are_counted_without_a_lambda_a_word(spark):
    rows = [(1, "b a B a_1 x"), (2, None), (3, ""), (4, "ÄB äb äb the the")]
    counted = term_counts(spark.createDataFrame(rows, "doc long, text string"), "doc", "text", stop_words=["the"])
    assert "lambda" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc, r.term, r.tf) for r in counted.collect()) == [(1, "a_1", 1), (4, "äb", 3)]
