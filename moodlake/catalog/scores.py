"""Sentiment scores and what is summarised from them."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.catalog.registry import query, round6, sql_exact_mean6, sql_list, table
from moodlake.operators.clustering import embed_hashing as embed_hashed
from moodlake.operators.clustering import embed_model
from moodlake.operators.scoring import score_model, score_words
from moodlake.catalog.records import page_text_sql
from moodlake.session import scratch_path
from moodlake.plans.changed import read_refreshed, refresh_changed
from moodlake.plans.daily import backfill_posts, news_job, posts_job, sentiment_by_group

# Our own word lists, from the vocabulary of the test texts.
POSITIVE = ("orre", "thatin", "inoran", "thre", "und", "los", "les")
NEGATIVE = ("ononst", "rewh", "hehely", "orantion", "nicht", "que", "una")


def _scored_sql(text: str, table: str = "documents") -> str:
    def hits(words):
        return (
            f"len(list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+'), lambda w: w IN ({sql_list(words)})))"
        )

    return f"""
      SELECT *, CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' ELSE 'neutral' END AS label,
             (greatest(pos, neg) + 1) / CAST(pos + neg + 2 AS DOUBLE) AS score
      FROM (SELECT *, {hits(POSITIVE)} AS pos, {hits(NEGATIVE)} AS neg FROM {table})
    """


@query(f"SELECT doc_id, label, round(score, 6) AS score FROM ({_scored_sql('text')})")
def score_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_words(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", POSITIVE, NEGATIVE)
    return scored.select("doc_id", "label", F.round("score", 6).alias("score"))


def _word_model():
    word = re.compile(r"\w+")
    positive, negative = frozenset(POSITIVE), frozenset(NEGATIVE)

    def score(texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            words = word.findall(text.lower())
            pos, neg = sum(w in positive for w in words), sum(w in negative for w in words)
            label = "negative" if neg > pos else "positive" if pos > neg else "neutral"
            out.append((label, (max(pos, neg) + 1) / (pos + neg + 2)))
        return out

    return score


@query(f"SELECT doc_id, label, round(score, 6) AS score, NULL AS error FROM ({_scored_sql('text')})")
def score_model_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_model(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", _word_model, ["doc_id"])
    return scored.select("doc_id", "label", F.round("score", 6).alias("score"), "error")


_BY_SOURCE = f"""
    WITH scored AS ({_scored_sql('text')}),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM scored) WHERE rn = 1)
    SELECT source, COUNT(*) AS n_rows, COUNT(*) FILTER (label = 'negative') AS n_label,
           round(COUNT(*) FILTER (label = 'negative') / COUNT(*), 6) AS share,
           {sql_exact_mean6("score", "label = 'negative'", "COUNT(score) FILTER (label = 'negative')")} AS mean_score,
           {sql_exact_mean6("score", "label = 'negative'", "COUNT(*)")} AS intensity
    FROM firsts GROUP BY source
"""


@query(f"SELECT source, n_rows, n_label, share, mean_score FROM ({_BY_SOURCE})")
def label_share_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct documents, scored, summarised per source."""
    summary = sentiment_by_group(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id", "text", "source", POSITIVE, NEGATIVE)
    return summary.select("source", "n_rows", "n_label", F.round("share", 6).alias("share"), round6("mean_score").alias("mean_score"))


@query(f"SELECT source, intensity FROM ({_BY_SOURCE})")
def label_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = sentiment_by_group(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id", "text", "source", POSITIVE, NEGATIVE)
    return summary.select("source", round6("intensity").alias("intensity"))


@query(
    """
    WITH words AS (
      SELECT doc_id, term, COUNT(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents) GROUP BY 1, 2),
    placed AS (
      SELECT doc_id, CAST(('0x' || substr(md5(term), 1, 8)) AS BIGINT) % 256 AS dim, sum(n) AS n FROM words GROUP BY 1, 2),
    sizes AS (SELECT doc_id, sqrt(sum(n * n)) AS size FROM placed GROUP BY 1)
    SELECT doc_id, dim, round(CAST(CAST(n / size AS FLOAT) AS DOUBLE), 6) AS weight FROM placed JOIN sizes USING (doc_id)
    """
)
def embed_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed word-count vectors, in long form: the places that are not zero."""
    embedded = embed_hashed(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    places = F.transform("embedding", lambda w, i: F.when(w != 0, F.struct(i.cast("long").alias("dim"), w.cast("double").alias("weight"))))
    held = embedded.select("doc_id", F.explode(F.filter(places, lambda x: x.isNotNull())).alias("x"))
    return held.select("doc_id", "x.dim", F.round("x.weight", 6).alias("weight"))


_LETTERS = "aeinst"


def _letter_model():
    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array([[t.count(c) for c in _LETTERS] for t in texts], dtype=np.float32)

    return predict


@query(
    "SELECT doc_id, "
    + ", ".join(f"CAST(length(text) - length(replace(text, '{c}', '')) AS DOUBLE) AS n_{c}" for c in _LETTERS)
    + " FROM documents"
)
def embed_model_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's model that maps a text to a vector, in batches of 32."""
    embedded = embed_model(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", _letter_model)
    return embedded.select("doc_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"n_{c}") for i, c in enumerate(_LETTERS)])


_TITLED = "(SELECT conv_id, turn, role, nullif(role, 'system') || ' ' || text AS body FROM conversations)"


@query(
    f"""
    WITH s AS ({_scored_sql("body", _TITLED)}), k AS (SELECT *, CASE WHEN body IS NOT NULL THEN label END AS l FROM s)
    SELECT 'overall' AS part, NULL AS role, COUNT(*) AS n_rows, round(COUNT(*) FILTER (l = 'negative') / COUNT(*), 6) AS share,
           {sql_exact_mean6("score", "l = 'negative'", "COUNT(score) FILTER (l = 'negative')")} AS mean_score FROM k
    UNION ALL SELECT 'group', role, NULL, NULL, {sql_exact_mean6("score", "l = 'negative'", "COUNT(score) FILTER (l = 'negative')")}
    FROM k WHERE body IS NOT NULL GROUP BY role
    UNION ALL SELECT 'failed', role, COUNT(*), NULL, NULL FROM k WHERE body IS NULL GROUP BY role
    """
)
def posts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts job over all conversations; one role has no title, so its posts fail."""
    posts = table(spark, sf_dir, "conversations").withColumn("title", F.expr("nullif(role, 'system')"))
    done = posts_job(posts, "title", "text", "role", ["conv_id", "turn"], POSITIVE, NEGATIVE)
    none = F.lit(None)
    overall = done.overall.select(F.lit("overall").alias("part"), none.cast("string").alias("role"), "n_rows", F.round("share", 6).alias("share"), round6("mean_score").alias("mean_score"))
    groups = done.by_group.select(F.lit("group").alias("part"), "role", none.cast("long").alias("n_rows"), none.cast("double").alias("share"), round6("mean_score").alias("mean_score"))
    failed = done.failed.groupBy("role").agg(F.count("*").alias("n_rows"))
    failed = failed.select(F.lit("failed").alias("part"), "role", "n_rows", none.cast("double").alias("share"), none.cast("double").alias("mean_score"))
    return overall.unionByName(groups).unionByName(failed)


@query(
    f"""
    WITH {page_text_sql("html")},
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM page_texts) WHERE rn = 1),
    s AS ({_scored_sql("text", "firsts")})
    SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, COUNT(*) AS n_rows, COUNT(*) FILTER (label = 'negative') AS n_label,
           {sql_exact_mean6("score", "label = 'negative'", "COUNT(score) FILTER (label = 'negative')")} AS mean_score
    FROM s WHERE contains(lower(url), 'example.com') OR contains(lower(url), 'example.org') GROUP BY 1
    """
)
def news_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The news job over all pages: two domains kept, text taken out of the pages, scored per host."""
    done = news_job(table(spark, sf_dir, "pages"), "url", "html", ["example.com", "example.org"], ["page_id"], POSITIVE, NEGATIVE)
    return done.select("host", "n_rows", "n_label", round6("mean_score").alias("mean_score"))


@query(
    f"""
    WITH p AS (SELECT DATE '2024-01-01' + CAST(turn AS INTEGER) AS day, role || ' ' || text AS body FROM conversations),
    s AS ({_scored_sql("body", "p")}), days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d)
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date, COUNT(label) AS n_rows, COUNT(*) FILTER (label = 'negative') AS n_label,
           {sql_exact_mean6("score", "label = 'negative'", "COUNT(score) FILTER (label = 'negative')")} AS mean_score
    FROM days LEFT JOIN s ON s.day = CAST(d AS DATE) GROUP BY 1
    """
)
def backfill_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts, a turn standing for a day, scored and summarised for a whole month."""
    posts = table(spark, sf_dir, "conversations").withColumn("ts", F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).cast("timestamp"))
    done = backfill_posts(posts, "2024-01-01", "2024-01-31", "role", "text", "role", POSITIVE, NEGATIVE)
    return done.select(F.col("date").cast("string").alias("date"), "n_rows", "n_label", round6("mean_score").alias("mean_score"))


@query(
    f"""
    WITH p AS (SELECT DATE '2024-01-01' + CAST(turn AS INTEGER) AS day, turn, role || ' ' || CASE WHEN turn = 2 THEN 'nicht que ' || text ELSE text END AS body
               FROM conversations WHERE turn <> 1),
    s AS ({_scored_sql("body", "p")})
    SELECT CAST(day AS VARCHAR) AS date, COUNT(label) AS n_rows, COUNT(*) FILTER (label = 'negative') AS n_label,
           {sql_exact_mean6("score", "label = 'negative'", "COUNT(score) FILTER (label = 'negative')")} AS mean_score, turn = 2 AS rewritten
    FROM s GROUP BY day, turn
    """
)
def backfill_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a month: by the second one the texts of a day have changed and those of another are
    gone. Only these days are scored and written again; the result is that of a full run."""
    ts = F.date_add(F.lit("2024-01-01").cast("date"), F.col("turn").cast("int")).cast("timestamp")
    posts = table(spark, sf_dir, "conversations").select("role", "text", "turn", ts.alias("ts"))
    text = F.when(F.col("turn") == 2, F.concat(F.lit("nicht que "), F.col("text"))).otherwise(F.col("text"))
    later = posts.withColumn("text", text).filter("turn <> 1")
    path, month = scratch_path(spark, "backfill-changed"), ("2024-01-01", "2024-01-31")
    measures = ["date", "n_rows", "n_label", "mean_score"]

    def summarise(rows: DataFrame) -> DataFrame:
        return backfill_posts(rows, *month, "role", "text", "role", POSITIVE, NEGATIVE).filter("n_rows > 0").select(*measures)

    refresh_changed(posts, path, *month, summarise, ["role", "text"])
    days = refresh_changed(later, path, *month, summarise, ["role", "text"])
    stored = read_refreshed(spark, path, summarise(posts).schema)
    again = F.col("date").isin([F.lit(d) for d in days]).alias("rewritten")
    return stored.select(F.col("date").cast("string").alias("date"), "n_rows", "n_label", round6("mean_score").alias("mean_score"), again)
