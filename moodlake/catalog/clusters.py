"""K-means, silhouettes, representative texts and the cluster report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.catalog.records import STOP_WORDS
from moodlake.catalog.registry import query, round6, sql_list, table
from moodlake.operators import clustering, text_clusters
from moodlake.operators.representatives import representative_texts
from moodlake.operators.silhouette import silhouette
from moodlake.plans.clusters import cluster_texts
from moodlake.session import scratch_path


def _planted(spark: SparkSession, sf_dir: str, groups: int) -> DataFrame:
    """All vectors, moved far apart by ``label`` modulo ``groups``, so that the clusters are known."""
    moved = F.transform("embedding", lambda x, i: x + F.when(i == F.col("label") % groups, 100.0).otherwise(0.0))
    return table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("embedding"))


def _named(assigned: DataFrame) -> DataFrame:
    """Clusters by their smallest id instead of a number that depends on the start."""
    first = assigned.groupBy("cluster").agg(F.min("vec_id").alias("first_id"))
    return assigned.join(first, "cluster").select("vec_id", F.col("first_id").alias("cluster"))


@query("SELECT vec_id, min(vec_id) OVER (PARTITION BY label % 10) AS cluster FROM embeddings")
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten clusters, best of ten starts."""
    vectors = _planted(spark, sf_dir, 10)
    return _named(clustering.assign(clustering.fit_kmeans(vectors, 10), vectors).select("vec_id", "cluster"))


@query("SELECT vec_id, min(vec_id) OVER (PARTITION BY label % 4) AS cluster, 4 AS k FROM embeddings")
def kmeans_best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters at the k from 3 to 10 with the highest silhouette."""
    vectors = _planted(spark, sf_dir, 4)
    best = clustering.best_k(vectors)
    return _named(clustering.assign(best.model, vectors).select("vec_id", "cluster")).withColumn("k", F.lit(best.k))


def _silhouette_sql(distance: str) -> str:
    return f"""
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (
      SELECT a.vec_id, a.label AS own, b.label AS other, sum({distance}) AS s, COUNT(*) AS n
      FROM v a CROSS JOIN v b GROUP BY a.vec_id, a.label, b.label),
    parts AS (
      SELECT vec_id, own, max(n) FILTER (own = other) AS size, max(s / nullif(n - 1, 0)) FILTER (own = other) AS a,
             min(s / n) FILTER (own <> other) AS b FROM pairs GROUP BY vec_id, own),
    sil AS (SELECT vec_id, own AS label, CASE WHEN size = 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM parts)
    """


@query(_silhouette_sql("list_distance(a.e, b.e) ** 2") + "SELECT round(avg(silhouette), 6) AS silhouette FROM sil")
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = clustering.silhouette_squared(table(spark, sf_dir, "embeddings"), "label")
    return spark.createDataFrame([(score,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


@query(
    _silhouette_sql("list_distance(a.e, b.e)")
    + "SELECT label, COUNT(*) AS n_rows, round(avg(silhouette), 6) AS silhouette, 0.0 AS error FROM sil GROUP BY label"
)
def silhouette_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain distances, per cluster; a table of at most 4,096 distinct vectors has no error left."""
    found = silhouette(table(spark, sf_dir, "embeddings"), "label")
    return found.select("label", "n_rows", round6("silhouette").alias("silhouette"), round6("error").alias("error"))


@query(
    """
    SELECT label, COUNT(*) AS size, round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM embeddings), 6) AS percentage
    FROM embeddings GROUP BY label
    """
)
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = clustering.cluster_sizes(table(spark, sf_dir, "embeddings"), "label")
    return sizes.withColumn("percentage", F.round("percentage", 6))


@query("SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY ALL")
def cluster_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events stand for clusters, users for groups."""
    return clustering.cluster_group_counts(table(spark, sf_dir, "events"), "event_type", "user_id")


def _representatives_sql(top_n: int, docs: str = "documents") -> str:
    return f"""
    terms AS (
      SELECT doc_id, source, term, COUNT(*) AS tf
      FROM (SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {docs})
      WHERE term NOT IN ({sql_list(STOP_WORDS)}) GROUP BY doc_id, source, term),
    df AS (SELECT source, term, COUNT(*) AS df FROM terms GROUP BY source, term),
    sizes AS (SELECT source, COUNT(*) AS n FROM {docs} GROUP BY source),
    weights AS (
      SELECT doc_id, tf * (ln((1.0 + n) / (1.0 + df)) + 1) AS w
      FROM terms JOIN df USING (source, term) JOIN sizes USING (source)),
    scores AS (SELECT doc_id, sum(w) / sqrt(sum(w * w)) AS score FROM weights GROUP BY doc_id),
    ranked AS (
      SELECT doc_id, source, text, coalesce(score, 0) AS score,
             row_number() OVER (PARTITION BY source ORDER BY round(coalesce(score, 0), 9) DESC, doc_id) AS rank
      FROM {docs} LEFT JOIN scores USING (doc_id)),
    reps AS (SELECT * FROM ranked WHERE rank <= {top_n})
    """


@query(f"WITH {_representatives_sql(5)} SELECT source, rank, doc_id, round(score, 6) AS score, text FROM reps")
def tfidf_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    top = representative_texts(docs, "doc_id", "source", "text", stop_words=STOP_WORDS)
    return top.withColumn("score", F.round("score", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(
    f"""
    WITH {_representatives_sql(1)},
    groups AS (SELECT source, string_agg(lang || ':' || n, ',' ORDER BY lang) AS group_distribution
               FROM (SELECT source, lang, COUNT(*) AS n FROM documents GROUP BY source, lang) GROUP BY source)
    SELECT source, n AS size, round(n * 100.0 / (SELECT COUNT(*) FROM documents), 6) AS percentage,
           substr(text, 1, 100) AS representative, group_distribution
    FROM sizes JOIN reps USING (source) JOIN groups USING (source)
    """
)
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    report = clustering.cluster_report(docs, "doc_id", "source", "lang", "text", stop_words=STOP_WORDS)
    entries = F.transform(F.array_sort(F.map_entries("group_distribution")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return report.withColumn("percentage", F.round("percentage", 6)).withColumn("group_distribution", F.array_join(entries, ","))


_GROUPS = 4
_DIMS = 1024


def _planted_texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents, and the vectors of their texts moved far apart by ``doc_id`` modulo the
    groups: one more place with a large weight, then unit length again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    vectors = text_clusters.hashed_places(docs, "text", _DIMS).select("doc_id", "places", "weights")
    size = F.lit(1 / 101**0.5)
    place = (F.lit(_DIMS) + F.col("doc_id") % _GROUPS).cast("int")
    return docs, vectors.select(
        "doc_id", F.concat("places", F.array(place)).alias("places"),
        F.transform(F.concat("weights", F.array(F.lit(10.0))), lambda w: w * size).alias("weights"),
    )


_PLANTED_SQL = f"d AS (SELECT doc_id, text, lang, doc_id % {_GROUPS} AS source FROM documents)"


@query(
    f"""
    WITH {_PLANTED_SQL}, {_representatives_sql(1, "d")},
    groups AS (SELECT source, string_agg(lang || ':' || n, ',' ORDER BY lang) AS group_distribution
               FROM (SELECT source, lang, COUNT(*) AS n FROM d GROUP BY source, lang) GROUP BY source),
    names AS (SELECT source, min(doc_id) AS cluster FROM d GROUP BY source)
    SELECT cluster, n AS size, round(n * 100.0 / (SELECT COUNT(*) FROM d), 6) AS percentage,
           substr(text, 1, 100) AS representative, group_distribution
    FROM sizes JOIN reps USING (source) JOIN groups USING (source) JOIN names USING (source)
    """
)
def cluster_texts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering job on all texts, k from 3 to 6 by silhouette; clusters by their smallest id."""
    docs, vectors = _planted_texts(spark, sf_dir)
    done = cluster_texts(
        docs, scratch_path(spark, "text-clusters"), "doc_id", "lang", "text", vectors, _DIMS + _GROUPS, range(3, 7), STOP_WORDS, starts=4
    )
    names = done.assigned.groupBy("cluster").agg(F.min("doc_id").alias("name"))
    entries = F.transform(F.array_sort(F.map_entries("group_distribution")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return done.report.join(names, "cluster").select(
        F.col("name").alias("cluster"), "size", F.round("percentage", 6).alias("percentage"), "representative",
        F.array_join(entries, ",").alias("group_distribution"),
    )


@query(f"SELECT doc_id, lang, doc_id % {_GROUPS} AS cluster FROM documents")
def cluster_texts_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored assignments of the same job for one k, read back by key."""
    docs, vectors = _planted_texts(spark, sf_dir)
    done = cluster_texts(docs, scratch_path(spark, "text-assigned"), "doc_id", "lang", "text", vectors, _DIMS + _GROUPS, [_GROUPS], starts=4)
    names = done.assigned.groupBy("cluster").agg(F.min("doc_id").alias("name"))
    return done.assigned.join(names, "cluster").select("doc_id", "lang", F.col("name").alias("cluster"))
