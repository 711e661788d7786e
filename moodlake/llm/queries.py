"""The registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.llm import (
    byte_pairs,
    decontaminate,
    fingerprints,
    language,
    phrases,
    pieces,
    pii,
    quality,
    ranked,
    repeats,
    simhash_dedup,
    token_counts,
    urls,
)
from moodlake.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_bytes(read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_near_counts(fingerprints.edited_fingerprints(read(spark, sf_dir, "documents")))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), with_ids=False)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = byte_pairs.encode(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PHRASES_SQL = rf"""
WITH pieces AS (
  SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[\x20\x09]+') IF w <> ''] AS ws
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), totals AS (
  SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces WHERE len(ws) > 0
), grams AS (
  SELECT lang, g, count(*)::BIGINT AS f
  FROM (SELECT lang, ws[i : i + m - 1] AS g FROM starts, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE i + m - 1 <= len(ws))
  GROUP BY lang, g HAVING count(*) >= 30
), cuts AS (
  SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM grams WHERE len(g) > 1
), scored AS (
  SELECT c.lang, c.g, c.f, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
  FROM cuts c
  JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : c.k]
  JOIN grams y ON y.lang = c.lang AND y.g = c.g[c.k + 1 :]
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), places AS (
  SELECT lang, g, f, m, unnest(range(1, len(g) - m + 2)) AS i
  FROM grams, (SELECT unnest([2, 3]) AS m) WHERE m < len(g)
), longer AS (
  SELECT lang, g[i : i + m - 1] AS g, max(f) AS f FROM places GROUP BY 1, 2
), kept AS (
  SELECT p.lang, array_to_string(p.g, ' ') AS phrase, p.f AS a, p.l, p.r, p.score
  FROM lowest p LEFT JOIN longer o ON o.lang = p.lang AND o.g = p.g
  WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * p.f
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
       phrase, a, l, r, t.n, score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""

RANKED_SQL = rf"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), docs AS (
  SELECT doc_id, ts, len(ts)::BIGINT AS n FROM found WHERE len(ts) > 0
), whole AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs
), asked AS (
  SELECT item_id, t, count(*)::BIGINT AS times
  FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark
  ) GROUP BY item_id, t
), postings AS (
  SELECT doc_id, n, t, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, n, unnest(ts) AS t FROM docs) WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, n, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*)::BIGINT AS df FROM postings GROUP BY t), whole
), impacts AS (
  SELECT p.doc_id, p.t,
         w.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS impact
  FROM postings p JOIN weights w ON w.t = p.t, whole
), scores AS (
  SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score
  FROM asked a JOIN impacts i ON i.t = a.t GROUP BY item_id, doc_id HAVING sum(times * impact) > 0
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores QUALIFY rank <= 20
"""

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_token_counts,
        op3_fingerprints,
        op4_simhash_dedup,
        op5_decontaminate,
        op6_pii,
        op7_sentencepiece,
        op8_quality_classifier,
        op9_url_filter,
        op10_language_id,
        op11_phrases,
        op12_byte_bpe,
        op13_ranked_search,
    )
}
#: The other queries need tokenizers, trained models, XXH64 shingles or places of matches.
ORACLES: dict[str, str] = {"op11_phrases": PHRASES_SQL, "op13_ranked_search": RANKED_SQL}
