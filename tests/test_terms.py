"""Long lists of terms and hosts, article bodies, clusters of texts, gaps between days."""

import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlake.functions import terms
from moodlake.functions import text as tx
from moodlake.operators import joins, text_clusters
from moodlake.plans.clusters import cluster_texts


@pytest.mark.parametrize("window", [1, 3, 1024])
@pytest.mark.parametrize("cells", [256, 1 << 24])
def test_automaton_finds_every_term(monkeypatch, window, cells):
    monkeypatch.setattr(terms, "WINDOW", window)
    monkeypatch.setattr(terms, "TABLE_CELLS", cells)
    draw = random.Random(window)
    word = lambda n: "".join(draw.choice("abÄ ") for _ in range(n))
    listed = ["", "he", "she", "his", "hers", "ab", "ab", "babab", "x" * 40, *(word(draw.randrange(1, 6)) for _ in range(60))]
    texts = ["", "ushers", "x" * 39, "x" * 41 + "he", *(word(draw.randrange(0, 60)) for _ in range(200))]
    lists = terms._automata(listed, False)
    for numbers, raw in lists:
        built = terms.Automaton(raw)
        want = [{i for i, t in enumerate(raw) if t in x.encode()} for x in texts]
        assert built.which([x.encode() for x in texts]) == want
        assert built.any([x.encode() for x in texts]).tolist() == [bool(w) for w in want]
    assert sorted(listed[i] for numbers, _ in lists for i in numbers) == sorted(set(listed) - {""})


def test_terms_in_texts(spark):
    rows = [(1, "The USHERS"), (2, None), (3, ""), (4, "nothing"), (5, "É he")]
    frame = spark.createDataFrame(rows, "id int, t string")
    listed = ["he", "she", "HE", "é", ""]
    got = frame.select("id", terms.holds_term("t", listed).alias("h"), terms.terms_in("t", listed).alias("n")).collect()
    assert {r.id: (r.h, r.n) for r in got} == {1: (True, [0, 1]), 2: (False, []), 3: (False, []), 4: (False, []), 5: (True, [0, 3])} | {4: (False, [])}
    exact = frame.select("id", terms.holds_term("t", ["USH"], ignore_case=False).alias("h")).collect()
    assert {r.id for r in exact if r.h} == {1}
    assert frame.select(terms.holds_term("t", []).alias("h")).filter("h").count() == 0


def test_texts_are_taken_some_windows_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(terms, "WINDOW", 8)
    monkeypatch.setattr(terms, "WINDOWS", 4)
    monkeypatch.setattr(terms, "HITS", 3)
    built, taken = terms.Automaton([b"he", b"she", b"x"]), []
    texts = (taken.append(i) or (b"ushers" if i % 2 else b"x") for i in range(100))
    held = built.held(texts)
    who, found = next(held)
    assert len(taken) <= 5 and list(zip(who, found)) == [(0, 2), (1, 0), (1, 1), (2, 2), (3, 0), (3, 1)]
    assert sum(len(w) for w, _ in held) == 48 * 3
    long = [b"x " * 20 + b"she " * 30, b"", b"he" * 40]
    assert built.which(long) == [{0, 1, 2}, set(), {0}]


def test_queries_bound_the_rows_of_a_python_worker(spark):
    from moodlake.catalog.registry import QUERIES, query

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    other = spark.newSession()
    other.conf.set(key, "10000")
    assert query(name="_rows")(lambda session, _: session.conf.get(key))(other, "") == "1000"
    del QUERIES["_rows"]


def test_hosts_of_a_list(spark):
    urls = ["http://a.example.com/x", "https://EXAMPLE.com", "http://badexample.com", None, "mailto:x", "http://u@b.c.d:80/", "http://c.d", "http://x.b.c.d/"]
    frame = spark.createDataFrame(list(enumerate(urls)), "id int, url string")
    on = frame.filter(terms.on_hosts("url", ["Example.com", "b.c.d", ""]))
    assert sorted(r.id for r in on.collect()) == [0, 1, 5, 7]
    assert frame.filter(terms.on_hosts("url", [])).count() == 0


def test_article_body(spark):
    menu = "<div class='main-nav'>" + "".join(f"<a href=/{i}>Go to {i}</a>" for i in range(9)) + "</div>"
    text = "<h1>Head line</h1><p>" + "word " * 40 + "</p><p>Short one.</p><div>" + "more <a href=/x>link</a> words of a text " * 12 + "</div>"
    foot = "<ul>" + "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(9)) + "</ul><footer><p>" + "legal " * 50 + "</p></footer>"
    rows = [
        (1, f"<html><head><title>{'t ' * 90}</title></head><body>{menu}{text}{foot}</body></html>"), (2, None), (3, ""), (4, "<br><p></p>"),
        (5, "plain &amp; simple"), (6, "<p>" + "a " * 5000 + "</p>" + menu + "<p>" + "b " * 30 + "</p>"),
    ]
    got = {r.id: r.body for r in tx.article_body(spark.createDataFrame(rows, "id int, html string"), "html").collect()}
    body = ("word " * 40).strip() + "\nShort one.\n" + ("more link words of a text " * 12).strip()
    assert got == {1: "Head line\n" + body, 2: None, 3: "", 4: "", 5: "plain & simple", 6: ("a " * 5000).strip()}


def test_vectors_of_texts_are_those_of_the_dense_form(spark):
    from moodlake.operators.clustering import embed_hashing

    rows = [(1, "One two two"), (2, ""), (3, None), (4, "ünï x1 _a ² Ⅷ a"), (5, "word " * 3000 + "other")]
    frame = spark.createDataFrame(rows, "id int, t string")
    both = text_clusters.hashed_places(embed_hashing(frame, "t", 64), "t", 64).collect()
    for r in both:
        if r.id == 3:
            assert r.places is None and r.weights is None
            continue
        dense = np.zeros(64)
        dense[r.places] = r.weights
        assert np.allclose(dense, np.array(r.embedding), atol=1e-6) and sorted(r.places) == r.places


def test_vectors_of_a_batch_are_those_of_its_texts():
    from moodlake.functions.hashing import unit_counts, unit_rows

    texts = ["one two two", "", "ünï x1 _a ² ⅷ a", "word " * 3000 + "other", "x", "one one"]
    many, at, of = unit_rows(texts, 16)
    ends = np.cumsum(many)[:-1]
    for text, p, w in zip(texts, np.split(at, ends), np.split(of, ends), strict=True):
        places, weights = unit_counts(text, 16)
        assert p.tolist() == places.tolist() and w.tolist() == weights.tolist()
    assert [len(x) for x in unit_rows([], 16)] == [0, 0, 0]


def test_vectors_are_made_once(spark, tmp_path):
    """For the fit and the assignments together, and held by no pass as a Python object a row."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def places(i):
        made.add(1)
        return [i % 2]

    docs = spark.range(40).select("id", F.lit("g").alias("g"), F.lit("some words").alias("t"))
    vectors = docs.select("id", places("id").alias("places"), F.array(F.lit(1.0)).alias("weights"))
    done = cluster_texts(docs, f"{tmp_path}/out", "id", "g", "t", vectors, 2, [2], starts=2)
    assert done.assigned.groupBy("cluster").count().count() == 2 and made.value == 40
    plan = text_clusters.assign(done.best.model, vectors)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_cluster_texts_job(spark, tmp_path):
    words = {0: "apple pear plum", 1: "steel iron zinc", 2: "river lake sea"}
    rows = [(i, "g%d" % (i % 2), (words[i % 3] + " ") * (1 + i % 4) + "filler%d" % i) for i in range(60)] + [(60, "g0", None), (61, "g1", "")]
    docs = spark.createDataFrame(rows, "id long, g string, t string")
    vectors = text_clusters.hashed_places(docs, "t", 512)
    done = cluster_texts(docs, f"{tmp_path}/out", "id", "g", "t", vectors.filter("size(places) > 0"), 512, range(2, 6), starts=5)
    assert done.best.k == 3
    found = {}
    for r in done.assigned.collect():
        found.setdefault(r.cluster, set()).add(r.id)
    assert sorted(map(min, found.values())) == [0, 1, 2] and all(len({i % 3 for i in ids}) == 1 for ids in found.values())
    report = done.report.collect()
    assert sorted(r["size"] for r in report) == [20, 20, 20] and sum(sum(r.group_distribution.values()) for r in report) == 60
    # Copies of one text as a third of all rows, and fewer distinct texts than clusters.
    same = spark.createDataFrame([(i, "same words here" if i % 3 else "other thing") for i in range(300)], "id long, t string")
    best = text_clusters.best_k(text_clusters.hashed_places(same, "t", 64), 64, [4], starts=2)
    assert sorted(best.model.sizes.tolist())[-2:] == [100, 200] and best.model.cost < 1e-9
    with pytest.raises(ValueError):
        text_clusters.best_k(text_clusters.hashed_places(same.limit(0), "t", 64), 64, [2])


def test_missing_ranges(spark):
    days = lambda *ds: [date(2024, 1, d) for d in ds]
    rows = [("a", d) for d in days(3, 4, 4, 8, 10)] + [("b", d) for d in days(1)] + [("c", d) for d in days(10)] + [(None, d) for d in days(1, 10)]
    rows += [("d", None), ("e", None), ("e", date(2024, 1, 5))]
    frame = spark.createDataFrame(rows, "k string, date date")
    got = sorted(((r.k, r.first.day, r.last.day) for r in joins.missing_ranges(frame, ["k"]).collect()), key=str)
    assert got == sorted([("a", 1, 2), ("a", 5, 7), ("a", 9, 9), ("b", 2, 10), ("c", 1, 9), (None, 2, 9), ("e", 1, 4), ("e", 6, 10)], key=str)
    assert joins.missing_days(frame, ["k"]).count() == 2 + 3 + 1 + 9 + 9 + 8 + 4 + 5
    assert joins.missing_ranges(frame.limit(0), ["k"]).count() == 0
    plan = joins.missing_days(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_late_rows_are_reported(spark, tmp_path):
    from moodlake.streaming import streams

    batches = [[(1, "10:00"), (2, "15:00"), (7, None)], [(3, "14:31"), (4, "11:00"), (5, "13:45"), (6, "15:01")]]
    schema = spark.createDataFrame([], "id int, ts timestamp").schema
    for i, rows in enumerate(batches):
        made = spark.createDataFrame([(i, t and f"2024-01-01 {t}:00") for i, t in rows], "id int, t string")
        made.select("id", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/b{i}")
    stream = streams.read_files(spark, f"{tmp_path}/in/*", schema, files_per_batch=1)
    counts, late = streams.run_slots_and_late(streams.slots_and_late(stream, "ts", "1 hour", ["id"], 60, salts=3), f"{tmp_path}/out")
    assert {r.slot.hour: r.n_rows for r in counts.collect()} == {10: 1, 14: 1, 15: 2}
    assert sorted(r.record for r in late.collect()) == ['{"id":4}', '{"id":5}']
