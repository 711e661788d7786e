"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and no rows."""

import hashlib

import pytest
from pyspark.sql import types as T

from moodlake.llm import decontaminate, fingerprints, language, pieces, pii, quality, repeats, simhash_dedup, token_counts, urls
from moodlake.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, t string, h long, fp long"
LABELS = "doc_id long, quality int, toxic int"

LONG = "the quick brown fox jumps over a lazy dog near river bank " * 900
TEXTS = [None, "", " \n\t", "a", "Hello, world", LONG, "ünï ☃ 漢字 \U0001f600 naïve", "x" * 30_000, "12 34 " * 3000, "<|endoftext|> end"]


def _docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), 0.0, "clash", 1, 2) for i, t in enumerate(texts)]
    rows += [(None, "no id", None, None, None, None, None, None, None)] * 2 + [(3, "a", None, None, 1, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, TEXTS)


def _ops(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(None, 1, 0), (2, None, None)], LABELS)
    bench = spark.createDataFrame([(1, "quick brown fox jumps over a lazy dog"), (2, None), (None, "a b"), (3, "")], "item_id long, text string")
    return {
        "repeats": repeats.repeated_bytes,
        "tokens": lambda d: token_counts.token_counts(d, tokenizer_path("byte_bpe_50k.json")),
        "prints": lambda d: fingerprints.with_near_counts(fingerprints.edited_fingerprints(d)),
        "simhash": simhash_dedup.near_duplicates,
        "decontaminate": lambda d: decontaminate.search(d, bench),
        "pii": pii.report,
        "pieces": lambda d: pieces.encode(d, tokenizer_path("piece_bpe_32k.model")),
        "quality": lambda d: quality.score(d, quality.train(d, labels)),
        "language": lambda d: language.predict(d, language.train(d)),
    }


NAMES = ["repeats", "tokens", "prints", "simhash", "decontaminate", "pii", "pieces", "quality", "language"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(spark, odd, name):
    rows = _ops(spark)[name](odd).collect()
    ids = sorted((r.doc_id for r in rows), key=lambda x: (x is None, x))
    assert ids == [0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9, None, None]


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, odd, name):
    assert _ops(spark)[name](odd.limit(0)).count() == 0


def test_filters_keep_all_columns(spark, odd):
    model = quality.train(odd, spark.createDataFrame([], LABELS))
    bench = spark.createDataFrame([(1, "quick brown fox jumps over a lazy dog")], "item_id long, text string")
    for kept in (quality.accept(odd, model), simhash_dedup.keep_one(odd), decontaminate.clean(odd, bench), pii.mask(odd)):
        assert kept.dtypes == odd.dtypes
        assert kept.limit(0).count() == 0
        kept.collect()
    assert decontaminate.clean(odd, bench).filter("doc_id = 5").count() == 0
    assert pii.mask(odd).count() == odd.count()


def test_columns_named_like_the_operators_own(spark, odd):
    own = ["_id", "_h", "_cuts", "_kept", "_lang", "rid", "n_items", "component", "node", "e", "own"]
    named = odd.selectExpr("*", *[f"cast({k} as long) as {c}" for k, c in enumerate(own)])
    bench = spark.createDataFrame([(1, "quick brown fox jumps over a lazy dog")], "item_id long, text string")
    for kept in (simhash_dedup.keep_one(named), decontaminate.clean(named, bench), pii.mask(named)):
        assert kept.columns == named.columns
        assert all(r[c] == k for r in kept.collect() for k, c in enumerate(own))
    for name, op in _ops(spark).items():
        assert op(named).count() == odd.count(), name


def test_known_values(spark, odd):
    got = {r.doc_id: r for r in repeats.repeated_bytes(odd).filter("doc_id is not null").collect()}
    assert got[0].n_bytes == 0 and got[0].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[7].n_removed == 30_000 and got[7].n_spans == 1
    lang = {r.doc_id: r for r in language.predict(odd, language.train(odd)).collect()}
    assert [lang[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and lang[0].score == 0
    prints = {r.doc_id: r.fp for r in simhash_dedup.fingerprints(odd).collect()}
    assert prints[0] == prints[1] == prints[2] == 0


def test_urls_on_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme/en/"), (4, "http://"), (5, "HTTP://A.Example.NET/en/1?q#f"), (6, "x://net"), (7, "x://net/"),
        (8, "a://example.com/de/x"), (9, "a://sub.example.com/DE/"), (10, "s://b.org/fr/" + "y" * 5000), (11, "s://ÄB.org#/fr/"),
        (11, "s://ÄB.org#/fr/"), (None, "s://a.net/z"), (13, "a://notexample.com/de/"), (14, "a://h?x/net/"),
    ]
    pages = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, host string, path string")
    got = {r.page_id: (r.host, r.path[:12], r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert len(urls.judge(pages).collect()) == len(rows)
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[5] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[6][2] is None and got[7][2:] == ("net/", "block")
    assert got[8][2:] == ("example.com/de/", "block") and got[9][2] is None
    assert got[10][2:] == ("org/fr/", "allow") and got[11][:3] == ("Äb.org", "", None)
    assert got[13][2] is None and got[14][:2] == ("h", "")
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_templates_reject_by_labels(spark):
    rows = [(i, f"http://h.com/shop/item-{i}/buy") for i in range(40)] + [(100 + i, f"http://h.com/news/{i}") for i in range(40)]
    rows += [(200, "http://h.com/shop/other-999/buy"), (201, "http://h.com/news/77")]
    labels = spark.createDataFrame([(i, i < 100) for i in [*range(40), *range(100, 140)]], "page_id long, blocked boolean")
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, rules=(), labels=labels).collect()}
    assert got[200].verdict == "block" and got[201].verdict == "allow"
    assert got[200].template == "/shop/*/buy"


def test_schema_of_null_types(spark):
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    assert repeats.repeated_bytes(spark.createDataFrame([(1, None)], kind)).first().n_bytes == 0
