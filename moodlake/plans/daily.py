"""The daily jobs, each as one plan over any number of days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.functions.text import concat_clean, contains_any, has_url, html_to_text, text_status, url_host
from moodlake.operators.dedup import keep_first, keep_first_text
from moodlake.operators.scoring import score_words
from moodlake.operators.summary import group_label_mean, label_summary


def select_news(
    news: DataFrame, domains: Sequence[str], keywords: Sequence[str], url: str = "DocumentIdentifier",
    themes: str = "V2Themes", order: Sequence[str] = ("DATE", "GKGRECORDID"), literal: bool = True,
) -> DataFrame:
    """News with a web address on a listed domain and a listed theme, one row per address."""
    kept = news.filter(has_url(url) & contains_any(url, domains, literal) & contains_any(themes, keywords, literal))
    return keep_first(kept, [url], order)


def _exact(scored: DataFrame) -> DataFrame:
    """Scores as decimals, so that sums do not depend on the order of tasks."""
    return scored.withColumn("score", F.col("score").cast("decimal(18,9)"))


def sentiment_by_group(
    docs: DataFrame, doc: str, text: str, group: str, positive: Sequence[str], negative: Sequence[str],
    target: str = "negative", denominator: str = "scored",
) -> DataFrame:
    """Distinct texts, scored by word lists and summarised per group.

    Scoring comes before the shuffle, so what is shuffled is a hash, a label and a
    number instead of the text.
    """
    scored = _exact(score_words(docs, text, positive, negative))
    first = keep_first_text(scored, text, [doc])
    return label_summary(first, "label", "score", target, [group], denominator)


def parse_range(start: str, end: str) -> tuple[date, date]:
    """Two ISO dates in order; raises ValueError otherwise."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first > last:
        raise ValueError(f"start {start} is after end {end}")
    return first, last


def backfill(
    scored: DataFrame, start: str, end: str, label: str, score: str, target: str, ts: str = "ts",
    by: Sequence[str] = (), denominator: str = "scored",
) -> DataFrame:
    """The daily summary of every day of an inclusive range, all days in one job.

    Days without rows appear with zeros when there is no further grouping.
    """
    first, last = parse_range(start, end)
    kind = scored.schema[ts].dataType
    days = scored.filter((F.col(ts) >= F.lit(str(first)).cast(kind)) & (F.col(ts) < F.date_add(F.lit(last), 1).cast(kind)))
    summary = label_summary(days, label, score, target, [F.to_date(ts).alias("date"), *by], denominator)
    if by:
        return summary
    n_days = (last - first).days + 1
    every = scored.sparkSession.range(n_days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    return every.join(summary, "date", "left").na.fill(0)


@dataclass(frozen=True)
class PostsResult:
    """What the daily posts job writes: scored rows, failed rows and the two summaries."""

    scored: DataFrame
    failed: DataFrame
    overall: DataFrame
    by_group: DataFrame


def posts_job(
    posts: DataFrame, title: str, body: str, group: str, keep: Sequence[str], positive: Sequence[str], negative: Sequence[str],
    target: str = "negative", by: Sequence[str] = (),
) -> PostsResult:
    """Title and body joined, scored and summarised over all posts and per group.

    A post without a title or body is a failure: it gets no score, goes to ``failed``, and
    still counts in the denominator of the overall share.
    """
    joined = posts.withColumn("_text", concat_clean(title, body, "fail"))
    scored = score_words(joined, "_text", positive, negative).withColumn("_status", text_status("_text"))
    columns = list(dict.fromkeys([*keep, group, *by]))
    failed = scored.filter("_status = 'failed'").select(*columns, F.lit("title or body is missing").alias("error"))
    good = scored.filter("_status <> 'failed'").select(*columns, "label", "score")
    everything = scored.select(*columns, "label", "score")
    return PostsResult(
        good, failed,
        label_summary(_exact(everything), "label", "score", target, by, denominator="all"),
        group_label_mean(_exact(good), group, "label", "score", target),
    )


def news_job(
    pages: DataFrame, url: str, html: str, domains: Sequence[str], order: Sequence[str], positive: Sequence[str],
    negative: Sequence[str], target: str = "negative",
) -> DataFrame:
    """Pages of the listed domains, one per address: text taken out, scored, summarised per host.

    Filter and deduplication come first, so only pages that count are parsed.
    """
    first = keep_first(pages.filter(has_url(url) & contains_any(url_host(url), domains)), [url], order)
    texts = first.select(url_host(url).alias("host"), html_to_text(html).alias("_text"))
    return label_summary(_exact(score_words(texts, "_text", positive, negative)), "label", "score", target, ["host"])


def backfill_posts(
    posts: DataFrame, start: str, end: str, title: str, body: str, group: str, positive: Sequence[str], negative: Sequence[str],
    ts: str = "ts", target: str = "negative",
) -> DataFrame:
    """Raw posts of an inclusive range of days, joined, scored and summarised per day in one job.

    The range is cut before anything is scored; days without posts appear with zeros.
    """
    first, last = parse_range(start, end)
    kind = posts.schema[ts].dataType
    days = posts.filter((F.col(ts) >= F.lit(str(first)).cast(kind)) & (F.col(ts) < F.date_add(F.lit(last), 1).cast(kind)))
    scored = score_words(days.withColumn("_text", concat_clean(title, body)), "_text", positive, negative)
    return backfill(_exact(scored.select(ts, group, "label", "score")), start, end, "label", "score", target, ts)
