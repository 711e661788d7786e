"""Filters, keep-first, joins and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.catalog.registry import query, sql_list, table
from moodlake.functions import terms
from moodlake.functions import text as tx
from moodlake.functions import times as tm
from moodlake.operators import joins, series
from moodlake.operators.dedup import keep_first_text, union_batches
from moodlake.operators.representatives import token_totals
from moodlake.plans.daily import select_news

# Our own parameters for the filters.
DOMAINS = ("Example.org", "spam-farm.example", "blog.tionsh")
TERMS = ("ononst", "&&&", "nicht", "token =")
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "by", "as", "this", "are",
    "at", "from",
)

_URL = "CASE WHEN url LIKE '%#top' THEN NULL WHEN url LIKE 'http:%' THEN substr(url, 8) ELSE url END"


def _pages_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose address is null in some rows and lacks its scheme in others."""
    return table(spark, sf_dir, "pages").select("page_id", F.expr(_URL).alias("key"), "url")


@query(f"SELECT page_id, k AS key FROM (SELECT page_id, {_URL} AS k FROM pages) WHERE contains(k, 'http')")
def filter_has_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_with_gaps(spark, sf_dir).filter(tx.has_url("key")).select("page_id", "key")


@query(
    "SELECT page_id, url FROM pages WHERE "
    + " OR ".join(f"contains(lower(url), '{d.lower()}')" for d in DOMAINS)
)
def filter_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter(tx.contains_any("url", DOMAINS)).select("page_id", "url")


@query("SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains(lower(text), '{t}')" for t in TERMS))
def filter_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(tx.contains_any("text", TERMS)).select("doc_id")


# Lists of the most frequent words of all documents, long enough to need more than an expression.
_LIST = 5000
_LIST_SQL = f"""
    words AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS term FROM documents),
    terms AS (SELECT term FROM words GROUP BY term ORDER BY COUNT(*) DESC, term LIMIT {_LIST})
"""


def _frequent_words(spark: SparkSession, sf_dir: str) -> list[str]:
    words = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("term"))
    top = words.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(_LIST)
    return [r.term for r in top.collect()]


@query(
    f"""
    WITH {_LIST_SQL}
    SELECT page_id, COUNT(*) AS n_terms FROM pages JOIN terms ON contains(lower(html), term) GROUP BY page_id
    """
)
def filter_many_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that hold any of thousands of terms, and how many of them."""
    listed = _frequent_words(spark, sf_dir)
    held = table(spark, sf_dir, "pages").filter(terms.holds_term("html", listed))
    return held.select("page_id", F.size(terms.terms_in("html", listed)).cast("long").alias("n_terms"))


@query(
    f"""
    WITH {_LIST_SQL},
    hosts AS (SELECT page_id, url, '.' || lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host FROM pages)
    SELECT page_id, url FROM hosts WHERE EXISTS (SELECT 1 FROM terms WHERE ends_with(host, '.' || term || '.example.com'))
    """
)
def filter_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages on any of thousands of hosts or their subdomains."""
    listed = [f"{w}.Example.com" for w in _frequent_words(spark, sf_dir)]
    return table(spark, sf_dir, "pages").filter(terms.on_hosts("url", listed)).select("page_id", "url")


@query(
    f"""
    SELECT page_id, url FROM (
      SELECT page_id, url, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM pages
      WHERE contains(url, 'http') AND ({' OR '.join(f"contains(lower(url), '{d.lower()}')" for d in DOMAINS)})
        AND ({' OR '.join(f"contains(lower(html), '{t}')" for t in TERMS)}))
    WHERE rn = 1
    """
)
def select_news_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return select_news(pages, DOMAINS, TERMS, "url", "html", ["page_id"]).select("page_id", "url")


@query(
    """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 12:30:00' AND TIMESTAMP '2024-01-05 19:00:00'
    """
)
def filter_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = tm.within(table(spark, sf_dir, "events"), "ts", "2024-01-05 12:30:00", "2024-01-05 19:00:00", "closed")
    return kept.select("event_id", F.col("ts").cast("string").alias("ts"))


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def filter_date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", tm.STAMP).alias("stamp"))
    return stamped.filter(tm.on_day(F.col("stamp"), "2024-01-10"))


@query(
    """
    SELECT doc_id, source FROM (
      SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
    """
)
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first_text(table(spark, sf_dir, "documents"), "text", ["doc_id"]).select("doc_id", "source")


@query(
    """
    SELECT doc_id AS id, text, lang, 'documents' AS batch FROM documents
    UNION ALL SELECT item_id, text, NULL, 'benchmark' FROM benchmark
    """,
    name="union_batches",
)
def union_of_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", F.lit("documents").alias("batch"))
    more = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("batch"), "text", F.col("item_id").alias("id"))
    return union_batches(docs, more)


@query("SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def join_scores_to_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return joins.attach_scores(docs.select("doc_id", "source"), labels, "doc_id")


def _runs(events: DataFrame) -> DataFrame:
    """A morning and an evening run on every day of the events."""
    days = tm.calendar(events.select(F.to_date("ts").alias("date")))
    hours = F.explode(F.array(F.lit(12), F.lit(20))).alias("h")
    return days.select("date", hours).select(
        (F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))).alias("run_ts")
    )


_RUNS_SQL = """
    runs AS (
      SELECT d + INTERVAL 1 HOUR * h AS run_ts,
             strftime(d, '%Y-%m-%d') || CASE WHEN h < 13 THEN '-am' ELSE '-pm' END AS run_id,
             CASE WHEN h < 13 THEN d - INTERVAL 5 HOUR ELSE d + INTERVAL 750 MINUTE END AS start_ts,
             CASE WHEN h < 13 THEN d + INTERVAL 750 MINUTE ELSE d + INTERVAL 19 HOUR END AS end_ts
      FROM (SELECT unnest(generate_series((SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) FROM events),
                                          (SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) FROM events), INTERVAL 1 DAY)) AS d),
           (VALUES (12), (20)) AS v(h))
"""


@query(
    f"WITH {_RUNS_SQL} SELECT run_id, CAST(run_ts AS VARCHAR) AS run_ts, CAST(start_ts AS VARCHAR) AS start_ts, "
    "CAST(end_ts AS VARCHAR) AS end_ts FROM runs"
)
def run_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = tm.run_windows(_runs(table(spark, sf_dir, "events")), "run_ts")
    return windows.select("run_id", *[F.col(c).cast("string").alias(c) for c in ("run_ts", "start_ts", "end_ts")])


@query(
    f"WITH {_RUNS_SQL} SELECT e.event_id, r.run_id FROM events e JOIN runs r ON e.ts >= r.start_ts AND e.ts < r.end_ts"
)
def range_join_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    windows = tm.run_windows(_runs(events), "run_ts")
    return joins.assign_windows(events.select("event_id", "ts"), windows, "ts").select("event_id", "run_id")


@query(
    """
    WITH days AS (
      SELECT unnest(generate_series((SELECT CAST(min(CAST(ts AS DATE)) AS TIMESTAMP) FROM events),
                                    (SELECT CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) FROM events), INTERVAL 1 DAY)) AS d)
    SELECT u.user_id, strftime(d, '%Y-%m-%d') AS date FROM (SELECT DISTINCT user_id FROM events) u, days
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id AND CAST(e.ts AS DATE) = CAST(d AS DATE))
    """
)
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a user has no events."""
    actual = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date"))
    return joins.missing_days(actual, ["user_id"]).select("user_id", F.col("date").cast("string").alias("date"))


@query(
    """
    WITH ends AS (SELECT CAST(min(ts) AS DATE) AS low, CAST(max(ts) AS DATE) AS high FROM events),
    days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events UNION SELECT DISTINCT user_id, low - 1 FROM events, ends
             UNION SELECT DISTINCT user_id, high + 1 FROM events, ends),
    gaps AS (SELECT user_id, d + 1 AS first, lead(d) OVER (PARTITION BY user_id ORDER BY d) - 1 AS last FROM days)
    SELECT user_id, CAST(first AS VARCHAR) AS first, CAST(last AS VARCHAR) AS last FROM gaps WHERE first <= last
    """
)
def missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of days on which a user has no events."""
    actual = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date"))
    found = joins.missing_ranges(actual, ["user_id"])
    return found.select("user_id", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"))


@query(
    """
    SELECT doc_id, source FROM documents d
    WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
    """
)
def present_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    flagged = table(spark, sf_dir, "labels").filter("toxic = 1")
    return joins.present_in(docs, flagged, ["doc_id"])


@query("SELECT event_id, CAST(ts AS VARCHAR) AS ts, value FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 1")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = series.latest(table(spark, sf_dir, "events"), "ts", "event_id")
    return last.select("event_id", F.col("ts").cast("string").alias("ts"), "value")


@query("SELECT doc_id, n_chars, substr(text, 1, 100) AS preview FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 20")
def topk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = series.latest(table(spark, sf_dir, "documents"), "n_chars", "doc_id", n=20)
    return top.select("doc_id", "n_chars", tx.truncate("text", 100).alias("preview"))


_WS = " || ".join(f"chr({ord(c)})" for c in tx.WHITESPACE)


@query(
    f"""
    SELECT conv_id, turn, 'blank' AS policy, trim(trim(coalesce(t, ''), {_WS}) || ' ' || trim(b, {_WS}), {_WS}) AS text, 'ok' AS status
    FROM (SELECT conv_id, turn, nullif(role, 'system') AS t, text AS b FROM conversations)
    WHERE trim(coalesce(t, '') || b, {_WS}) <> ''
    UNION ALL
    SELECT conv_id, turn, 'fail', trim(t || ' ' || b, {_WS}), CASE WHEN t IS NULL THEN 'failed' ELSE 'ok' END
    FROM (SELECT conv_id, turn, nullif(role, 'system') AS t, text AS b FROM conversations)
    """
)
def text_concat_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields joined under both null policies; the title is null for one role."""
    rows = table(spark, sf_dir, "conversations").withColumn("title", F.expr("nullif(role, 'system')"))
    both = [
        rows.select("conv_id", "turn", F.lit(p).alias("policy"), tx.concat_clean("title", "text", p).alias("text"))
        for p in ("blank", "fail")
    ]
    return union_batches(*both).withColumn("status", tx.text_status("text")).filter("status <> 'empty'")


@query("SELECT doc_id, substr(text, 1, 512) AS head, length(substr(text, 1, 512)) AS n FROM documents")
def text_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = tx.truncate("text", 512)
    return table(spark, sf_dir, "documents").select("doc_id", head.alias("head"), F.char_length(head).cast("long").alias("n"))


@query(
    f"""
    SELECT term, COUNT(*) AS n FROM (
      SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents)
    WHERE term NOT IN ({sql_list(STOP_WORDS)}) GROUP BY term
    """
)
def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_totals(table(spark, sf_dir, "documents").select("text"), "text", STOP_WORDS)


@query(
    """
    SELECT strftime(s, '%Y%m%d%H%M%S') AS stamp FROM (
      SELECT unnest(generate_series(date_trunc('minute', lo), hi, INTERVAL 15 MINUTE)) AS s
      FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM events))
    """
)
def slot_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return tm.slot_grid(span, "lo", "hi").select("stamp")


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def epoch_to_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    epochs = table(spark, sf_dir, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"))
    return epochs.select("event_id", tm.epoch_to_iso(F.col("epoch")).alias("iso"))


@query(
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN NULL
           ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS date FROM events
    """
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in paths; one kind of row has a malformed date, another an impossible one."""
    day = F.date_format("ts", "yyyy-MM-dd")
    folder = (
        F.when(F.col("event_type") == "error", F.date_format("ts", "dd.MM.yyyy"))
        .when(F.col("event_type") == "click", "2024-02-31").otherwise(day)
    )
    paths = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("series/"), folder, F.lit("/data.csv")).alias("path"))
    return paths.select("event_id", tm.date_in_path(F.col("path")).cast("string").alias("date"))


_PLANTED = "&mdash;it&#8217;s&#x2026; &Eacute;&apos;&amp;lt;&unknown;"
_TAGS = "</?(p|div|h[1-6]|li|ul|ol|tr|table|section|blockquote)(\\s[^>]*)?/?>|<br(\\s[^>]*)?/?>"


def page_text_sql(html: str) -> str:
    """CTEs that end in ``page_texts (page_id, url, text)``: the text of every page."""
    return rf"""
    part AS (
      SELECT page_id, url, regexp_extract({html}, '(?is)<article[^>]*>(.*)</article>', 1) AS a FROM pages),
    cut AS (
      SELECT page_id, url, regexp_replace(a, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS t FROM part),
    lines AS (
      SELECT page_id, url, regexp_replace(regexp_replace(t, '(?i){_TAGS}', chr(10), 'g'), '<[^>]+>', '', 'g') AS t FROM cut),
    plain AS (
      SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(t,
        '&mdash;', chr(8212)), '&#8217;', chr(8217)), '&#x2026;', chr(8230)), '&Eacute;', chr(201)), '&apos;', chr(39)),
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS t FROM lines),
    page_texts AS (
      SELECT page_id, url,
        trim(regexp_replace(regexp_replace(t, '[ \t\r\f' || chr(160) || ']+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS text
      FROM plain)
    """


@query(f"WITH {page_text_sql("replace(html, '</p>', '" + _PLANTED + "</p>')")} SELECT page_id, text FROM page_texts")
def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with entities planted in their text: named, numbered, and one escaped twice."""
    planted = F.regexp_replace("html", "</p>", f"{_PLANTED}</p>")
    return table(spark, sf_dir, "pages").select("page_id", tx.html_to_text(planted).alias("text"))


# A page without an <article>: the same headline and paragraphs in plain blocks, with a menu and
# notices around them.
_MENU = "<div class=menu>" + "".join(f'<a href="/s{i}">Section number {i}</a> | ' for i in range(12)) + "</div>"
_FOOT = "<div>Short notice of nothing.<ul>" + "".join(f'<li><a href="/m{i}">More of this {i}</a></li>' for i in range(8)) + "</ul></div>"


@query(f"WITH {page_text_sql('html')} SELECT page_id, text FROM page_texts")
def article_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body found by density in pages whose <article> is taken away and that get more around it."""
    open_, shut = F.lit(f"{_MENU}<div>"), F.lit(f"</div>{_FOOT}")
    bare = F.replace(F.replace("html", F.lit("<article>"), open_), F.lit("</article>"), shut)
    pages = table(spark, sf_dir, "pages").select("page_id", bare.alias("html"))
    return tx.article_body(pages, "html", "text").select("page_id", "text")


@query("SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, COUNT(*) AS n FROM pages GROUP BY 1")
def url_host_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(tx.url_host("url").alias("host")).agg(F.count("*").alias("n"))
