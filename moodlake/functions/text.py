"""Text expressions. All are built-in column functions, so they stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from html.entities import name2codepoint

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true, so that
# trimming matches str.strip(). Spark's plain trim() removes U+0020 only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

WORD = r"[\p{L}\p{N}_]"


def english_stop_words() -> list[str]:
    """Spark's own English list, for callers without one."""
    return StopWordsRemover.loadDefaultStopWords("english")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim all leading and trailing white space."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def concat_clean(title: Column | str, body: Column | str, null_policy: str = "blank") -> Column:
    """Title, one space, body, trimmed.

    ``'blank'`` trims each part and reads null as empty text. ``'fail'`` joins the parts
    as they are and gives null when either is null, for the caller to treat as failed.
    """
    title, body = _col(title), _col(body)
    if null_policy == "blank":
        empty = F.lit("")
        return strip(F.concat(strip(F.coalesce(title, empty)), F.lit(" "), strip(F.coalesce(body, empty))))
    if null_policy == "fail":
        return strip(F.concat(title, F.lit(" "), body))
    raise ValueError(f"null_policy must be 'blank' or 'fail', not {null_policy!r}")


def text_status(text: Column | str) -> Column:
    """'failed' for null, 'empty' for zero length, otherwise 'ok'."""
    text = _col(text)
    return F.when(text.isNull(), "failed").when(F.char_length(text) == 0, "empty").otherwise("ok")


def truncate(c: Column | str, n: int = 512) -> Column:
    """First ``n`` characters: the input limit of a classifier, or a preview."""
    return F.left(_col(c), F.lit(n))


def contains_any(c: Column | str, terms: Iterable[str], literal: bool = True, ignore_case: bool = True) -> Column:
    """Does the text hold any of the terms? Null is false.

    ``literal=False`` takes the terms as patterns.
    """
    terms = [t for t in terms if t]
    if not terms:
        return F.lit(False)
    if literal:
        # Lower-cased once; a search for a literal does not backtrack.
        text = F.lower(_col(c)) if ignore_case else _col(c)
        hits = [F.contains(text, F.lit(t.lower() if ignore_case else t)) for t in dict.fromkeys(terms)]
        return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))
    return F.coalesce(_col(c).rlike(("(?iu)" if ignore_case else "") + "|".join(terms)), F.lit(False))


def has_url(c: Column | str) -> Column:
    return F.coalesce(F.contains(_col(c), F.lit("http")), F.lit(False))


def tokens(c: Column | str, min_len: int = 2) -> Column:
    """Lower-case runs of at least ``min_len`` word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(WORD + "{%d,}" % min_len), F.lit(0))


def find_words(c: Column | str, words: Iterable[str]) -> Column:
    """Every whole-word occurrence of the (lower-case) words, as an array.

    One pass over the text however many words there are.
    """
    body = "|".join(re.escape(w) for w in sorted(set(words)))
    if not body:
        return F.when(_col(c).isNotNull(), F.array().cast("array<string>"))
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(rf"(?<!{WORD})(?:{body})(?!{WORD})"), F.lit(0))


def url_host(c: Column | str) -> Column:
    """Lower-case host of an absolute URL, null if there is none. Never raises."""
    host = F.regexp_extract(_col(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(F.char_length(host) > 0, F.lower(host))


# Element contents that are never article text, then the tags that end a line.
_DROP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>"
_BREAK = r"(?i)<br\b[^>]*>|</?(?:p|div|h[1-6]|li|ul|ol|tr|table|section|blockquote)\b[^>]*>"
_ENTITY = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
_MARK = "\u0001"


def decode_entities(c: Column | str) -> Column:
    """HTML entities, numbered or named, as their characters; each once, unknown ones as they are."""
    text = F.translate(_col(c), _MARK, " ")
    parts = F.split(F.regexp_replace(text, _ENTITY, f"{_MARK}$1{_MARK}"), _MARK)
    names = F.create_map(*[F.lit(x) for n, p in name2codepoint.items() for x in (n, chr(p))], F.lit("apos"), F.lit("'"))

    def char(s: Column) -> Column:
        code = F.when(s.startswith("#x") | s.startswith("#X"), F.conv(F.substring(s, 3, 8), 16, 10)).when(
            s.startswith("#"), F.substring(s, 2, 8)
        )
        code = code.cast("int")
        real = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numbered = F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(F.when(code.isNotNull(), numbered).otherwise(F.try_element_at(names, s)), F.concat(F.lit("&"), s, F.lit(";")))

    decoded = F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, char(p)).otherwise(p)), "")
    return F.when(F.contains(_col(c), F.lit("&")), decoded).otherwise(_col(c))


def _plain(fragment: Column) -> Column:
    """The text of a piece of a page: tags gone, lines kept, entities decoded."""
    text = F.regexp_replace(fragment, _DROP, "")
    text = F.regexp_replace(text, _BREAK, "\n")
    text = F.regexp_replace(text, r"<[^>]+>", "")
    text = decode_entities(text)
    text = F.regexp_replace(text, "[ \\t\\r\\f\\u00a0]+", " ")
    text = F.regexp_replace(text, " ?\n[ \n]*", "\n")
    return strip(text)


def html_to_text(c: Column | str) -> Column:
    """Body text of a page: the <article> if there is one, else the <body>, else all.

    By tags alone; ``article_body`` finds the body of pages without an <article>. Headlines
    are part of the text.
    """
    page = _col(c)
    article = F.regexp_extract(page, r"(?is)<article\b[^>]*>(.*)</article>", 1)
    body = F.regexp_extract(page, r"(?is)<body\b[^>]*>(.*)</body>", 1)
    return _plain(F.when(F.char_length(article) > 0, article).when(F.char_length(body) > 0, body).otherwise(page))


# Elements around an article, and names that pages give to what is beside it.
_AROUND = r"(?is)<(head|nav|footer|aside|form)\b.*?</\1\s*>"
_BESIDE = r"(?i)\b(?:class|id|role)\s*=\s*[\"']?[^\"'>]*\b(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|footer|menu|nav\w*|promo\w*|related|share|sidebar|social|sponsor\w*|subscribe)\b"
_BLOCK = r"(?i)(</?(?:p|div|h[1-6]|li|ul|ol|dl|dd|dt|table|tr|section|main|header|blockquote|article|figure|pre)\b[^>]*>)"
_BLOCK_COST, _LINK_COST, _BESIDE_COST, _HEADLINE, _PARAGRAPH = 10, 2, 60, 20, 10


def article_body(df: DataFrame, html: str, out: str = "body") -> DataFrame:
    """Adds the body text of pages that need not mark it: the best run of neighbouring blocks.

    A page is cut at block tags. A block is worth its words outside links, less a cost for
    itself, its words in links, and a name that tells it stands beside the text; a headline and
    a paragraph are worth a little more. The run of blocks with the highest sum is the body, so
    that a short paragraph between long ones stays and navigation, notices and link lists at
    either end go. The earliest run on a tie; a null page has a null body, a page without words
    an empty one. Built-in expressions only.
    """
    page = F.regexp_replace(F.regexp_replace(F.translate(F.col(html), _MARK, " "), _DROP, ""), _AROUND, "")
    blocks = F.split(F.regexp_replace(page, _BLOCK, f"{_MARK}$1"), _MARK)

    def worth(block: Column) -> Column:
        tag = F.lower(F.regexp_extract(block, "^<(/?[A-Za-z0-9]+)", 1))
        bare = F.regexp_replace(F.regexp_replace(block, r"(?is)<a\b.*?(?:</a>|$)", " "), "<[^>]+>", " ")
        every = F.regexp_count(F.regexp_replace(block, "<[^>]+>", " "), F.lit(r"\S+"))
        plain = F.regexp_count(bare, F.lit(r"\S+"))
        beside = F.regexp_extract(block, "^(<[^>]*>)", 1).rlike(_BESIDE)
        return (
            plain - _LINK_COST * (every - plain) - _BLOCK_COST
            - F.when(beside, _BESIDE_COST).otherwise(0)
            + F.when((every > 0) & tag.isin("h1", "h2"), _HEADLINE).when((every > 0) & (tag == "p"), _PARAGRAPH).otherwise(0)
        )

    # Of a block without words nothing is lost or won: it costs nothing.
    scores = F.transform("_blocks", lambda b: F.when(F.regexp_replace(b, "<[^>]+>", "").rlike(r"\S"), worth(b)).otherwise(F.lit(0)))
    start = F.struct(*[F.lit(v).alias(n) for n, v in (("best", -(1 << 30)), ("a", 1), ("b", 0), ("sum", 0), ("from", 1), ("at", 0))])

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + 1
        fresh = s["sum"] <= 0
        total = F.when(fresh, x).otherwise(s["sum"] + x)
        since = F.when(fresh, at).otherwise(s["from"])
        better = total > s["best"]
        return F.struct(
            F.when(better, total).otherwise(s["best"]).alias("best"), F.when(better, since).otherwise(s["a"]).alias("a"),
            F.when(better, at).otherwise(s["b"]).alias("b"), total.alias("sum"), since.alias("from"), at.alias("at"),
        )

    cut = df.withColumn("_blocks", blocks).withColumn("_run", F.aggregate(scores, start, step))
    kept = F.array_join(F.slice("_blocks", F.col("_run.a"), F.col("_run.b") - F.col("_run.a") + 1), "")
    return cut.withColumn(out, _plain(kept)).drop("_blocks", "_run")
