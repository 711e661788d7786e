"""Text expressions on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from moodlake.functions import terms
from moodlake.functions import text as tx


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("raw", ["  a b \n", " x　", "\x1c\x85 y z ", "   ", "", "plain", "​kept"])
def test_strip_is_python_strip(spark, raw):
    assert one(spark, raw, tx.strip("x")) == raw.strip()


@pytest.mark.parametrize(
    "title,body,blank,fail",
    [
        ("A", "b", "A b", "A b"),
        (" A ", " b ", "A b", "A   b"),
        ("", "", "", ""),
        ("  ", "\n", "", ""),
        (None, "b", "b", None),
        ("A", None, "A", None),
        (None, None, "", None),
    ],
)
def test_concat_null_policies(spark, title, body, blank, fail):
    df = spark.createDataFrame([(title, body)], "t string, b string")
    row = df.select(tx.concat_clean("t", "b", "blank").alias("blank"), tx.concat_clean("t", "b", "fail").alias("fail")).first()
    assert (row.blank, row.fail) == (blank, fail)


def test_concat_rejects_other_policies():
    with pytest.raises(ValueError):
        tx.concat_clean("t", "b", "other")


@pytest.mark.parametrize("text,status", [(None, "failed"), ("", "empty"), ("x", "ok")])
def test_status(spark, text, status):
    assert one(spark, text, tx.text_status("x")) == status


def test_truncate_counts_characters(spark):
    text = "é😀" * 400
    assert one(spark, text, tx.truncate("x")) == text[:512]
    assert one(spark, None, tx.truncate("x")) is None


@pytest.mark.parametrize(
    "text,literal,found",
    [
        ("https://www.Example.COM/a", True, True),
        ("https://exampleXcom.net", True, False),
        ("https://exampleXcom.net", False, True),
        ("the s&p index", True, True),
        (None, True, False),
        ("", True, False),
        ("unfederal", True, True),
    ],
)
def test_contains_any(spark, text, literal, found):
    assert one(spark, text, tx.contains_any("x", ["example.com", "s&p", "fed"], literal)) is found


def test_contains_any_without_terms_or_case(spark):
    assert one(spark, "a", tx.contains_any("x", [])) is False
    assert one(spark, "ABC", tx.contains_any("x", ["abc"], ignore_case=False)) is False
    assert one(spark, "ÉTÉ", tx.contains_any("x", ["été"])) is True


@pytest.mark.parametrize("url,found", [("http://a", True), ("ftp://a", False), (None, False)])
def test_has_url(spark, url, found):
    assert one(spark, url, tx.has_url("x")) is found


@pytest.mark.parametrize(
    "url,host",
    [
        ("https://News.Example.com:8080/a?b#c", "news.example.com"),
        ("http://user@h.example/x", "h.example"),
        ("http://a_b.example", "a_b.example"),
        ("not a url", None),
        ("http://", None),
        ("", None),
        (None, None),
    ],
)
def test_url_host(spark, url, host):
    assert one(spark, url, tx.url_host("x")) == host


def test_tokens(spark):
    assert one(spark, "A Big, big_9 Été! x 東京", tx.tokens("x")) == ["big", "big_9", "été", "東京"]


def test_find_words_counts_whole_words_only(spark):
    assert one(spark, "Fed up? unfed, FED_1 fed", tx.find_words("x", ["fed"])) == ["fed", "fed"]
    assert one(spark, "anything", tx.find_words("x", [])) == []
    assert one(spark, None, tx.find_words("x", ["fed"])) is None


@pytest.mark.parametrize(
    "html,text",
    [
        ("<html><body><p>One &amp; two</p><p>three</p></body></html>", "One & two\nthree"),
        ("<body>x<article><h1>Head</h1><p>In <b>bold</b></p></article>y</body>", "Head\nIn bold"),
        ("a<script>var x='<p>no</p>'</script>b<!-- <p>c</p> -->d", "abd"),
        ("&amp;lt;", "&lt;"),
        ("plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_html_to_text(spark, html, text):
    assert one(spark, html, tx.html_to_text("x")) == text


def test_large_pages_do_not_overflow_the_stack(spark):
    page = "<article><p>" + "word <b>x</b> " * 150_000 + "</p></article>"
    assert one(spark, page, F.char_length(tx.html_to_text("x"))) == len("word x " * 150_000) - 1
    assert one(spark, "a" * 2_000_000, F.array_size(tx.tokens("x"))) == 1


def test_english_stop_words(spark):
    assert "the" in tx.english_stop_words()


def test_empty_html_is_empty_not_null(spark):
    assert one(spark, "<p> </p>", F.char_length(tx.html_to_text("x"))) == 0


def test_entities_are_decoded_once(spark):
    given = "a&#8217;b &mdash; c&#x27;d &amp;lt; &eacute;&apos; &nope; &#0; &#55555555; &#x1F600; x & y;"
    got = spark.createDataFrame([(given,), (None,), ("plain",)], "t string").select(tx.decode_entities("t").alias("t")).collect()
    assert got[0].t == "a\u2019b \u2014 c'd &lt; é' &nope; &#0; &#55555555; \U0001f600 x & y;"
    assert [r.t for r in got[1:]] == [None, "plain"]


def test_a_page_keeps_its_headline(spark):
    page = "<html><body><article><h1>Head</h1><p>Body</p></article></body></html>"
    assert spark.createDataFrame([(page,)], "h string").select(tx.html_to_text("h")).first()[0] == "Head\nBody"


def test_hosts_from_a_table(spark):
    urls = [(1, "http://a.example.com/x"), (2, "https://EXAMPLE.com"), (3, "http://badexample.com"), (4, None), (5, "mailto:x"), (2, "https://EXAMPLE.com")]
    hosts = spark.createDataFrame([("example.com",), ("A.example.com",), (None,)], "host string")
    got = terms.of_hosts(spark.createDataFrame(urls, "id int, url string"), "url", hosts)
    assert sorted(r.id for r in got.collect()) == [1, 2, 2] and got.columns == ["id", "url"]
