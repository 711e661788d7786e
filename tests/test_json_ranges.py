"""JSON arrays read in ranges of bytes, against a parser of whole files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from moodlake.catalog import transport
from moodlake.sources import json_ranges
from moodlake.sources.json_ranges import scan_json_ranges

SCHEMA = "id long, title string, more struct<list:array<string>,map:map<string,long>>"


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def records(n, seed):
    draw = random.Random(seed)
    bits = ["}", "{", "[", "]", '"', "\\", "},{", '"},{"id":', "\n", "é", "日本", "x" * 30, " ", ",", "\\\\", '\\"', "/"]

    def text():
        return "".join(draw.choice(bits) for _ in range(draw.randrange(12)))

    out = []
    for i in range(n):
        row = {"id": i}
        if draw.random() < 0.8:
            row["title"] = text()
        if draw.random() < 0.6:
            row["more"] = {"list": [text() for _ in range(draw.randrange(4))], "map": {f"k{j}": j for j in range(draw.randrange(3))}}
        out.append(row)
    return out


def plain(rows):
    return sorted(
        (r["id"], r.get("title"), None if r.get("more") is None else (tuple(r["more"]["list"]), tuple(sorted(r["more"]["map"].items()))))
        for r in rows
    )


@pytest.mark.parametrize("range_bytes", [9, 64, 1000, None])
def test_any_range_gives_the_records_of_the_whole_file(spark, tmp_path, schema, range_bytes):
    every = []
    for seed, (indent, ascii_only) in enumerate([(None, True), (2, False)]):
        rows = [r | {"id": r["id"] + 1000 * seed} for r in records(40, seed)]
        every += rows
        (tmp_path / f"{seed}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    got, dead = scan_json_ranges(spark, str(tmp_path), schema, range_bytes=range_bytes)
    assert plain(r.asDict(recursive=True) for r in got.collect()) == plain(every)
    assert dead.isEmpty()


def test_one_record_over_many_ranges(spark, tmp_path, schema):
    rows = [{"id": 0, "title": "}{" * 400}, {"id": 1, "title": "a"}, {"id": 2, "title": '"' * 300}]
    (tmp_path / "a.json").write_text("\n" + json.dumps(rows) + "\n")
    got, dead = scan_json_ranges(spark, str(tmp_path), schema, range_bytes=50)
    assert plain(r.asDict(recursive=True) for r in got.collect()) == plain(rows) and dead.isEmpty()


BROKEN = {
    "cut in a string": '[{"id": 1, "title": "a',
    "cut after a record": '[{"id": 1}',
    "cut after a comma": '[{"id": 1},',
    "no array": '{"id": 1}',
    "two arrays": '[{"id": 1}],[{"id": 2}]',
    "two arrays in lines": '[{"id": 1}]\n[{"id": 2}]',
    "no comma": '[{"id": 1} {"id": 2}]',
    "two commas": '[{"id": 1},,{"id": 2}]',
    "comma at the end": '[{"id": 1},]',
    "more after the end": '[{"id": 1}] x',
    "text before": 'x [{"id": 1}]',
    "a number among the records": '[{"id": 1}, 2, {"id": 3}]',
    "a number at the end": '[{"id": 1}, 2]',
    "wrong bracket": '[{"id": 1, "more": ]}, {"id": 2}, [}]',
    "bad record": '[{"id": 1}, {"id" 2}, {"id": 3}]',
    "one quote": '[{"id": 1, "title": "a"b"}, {"id": 2}]',
    "blank": " \n",
    "numbers": "[1, 2]",
}


@pytest.mark.parametrize("range_bytes", [7, None])
def test_a_broken_file_is_one_dead_letter_and_leaves_the_others(spark, tmp_path, schema, range_bytes):
    for name, text in BROKEN.items():
        (tmp_path / f"{name.replace(' ', '-')}.json").write_text(text)
    (tmp_path / "good.json").write_text('[{"id": 7, "title": NaN}, {"id": 8, "title": "NaN"}, {"id": 9, "title": "t"}]')
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "mark.json").write_text('[{"id": 10}]', encoding="utf-8-sig")
    got, dead = scan_json_ranges(spark, str(tmp_path), schema, nan_columns=["title"], range_bytes=range_bytes)
    assert sorted((r.id, r.title) for r in got.collect()) == [(7, None), (8, None), (9, "t"), (10, None)]
    letters = sorted(r.file.rsplit("/", 1)[1] for r in dead.collect())
    assert letters == sorted(f"{n.replace(' ', '-')}.json" for n in BROKEN)


def test_nan_stays_text_where_it_may_be_a_word(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text('[{"id": 1, "title": NaN}]')
    got, _ = scan_json_ranges(spark, str(tmp_path), schema)
    assert [r.title for r in got.collect()] == ["NaN"]


def test_files_without_records(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text("[]")
    got, dead = scan_json_ranges(spark, str(tmp_path), schema)
    assert got.count() == 0 and dead.count() == 0


def test_one_file_is_read_by_many_tasks(spark, tmp_path, schema):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "title": "x" * 200} for i in range(500)]))
    got, _ = scan_json_ranges(spark, str(tmp_path), schema, range_bytes=4096)
    assert got.agg(F.count("*").alias("n"), F.sum("id").alias("s")).first() == (500, 500 * 499 // 2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "ArrowEval" not in plan


def test_texts_are_shuffled_once(spark, tmp_path, schema, monkeypatch):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "title": "x" * 200} for i in range(100)]))
    pieces = json_ranges._pieces(spark, str(tmp_path), 4096)
    starts = json_ranges._starts(pieces)
    assert starts.count() > 1
    written = {}
    monkeypatch.setattr(json_ranges, "settle", lambda df, purpose: written.setdefault(purpose, df))
    json_ranges._parts(pieces, starts)
    plan = written["json-parts"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("n", [0, 1, 250])
def test_arrays_are_written_by_tasks_that_hold_a_batch(spark, tmp_path, n):
    texts = spark.range(n).select(F.to_json(F.struct("id")))
    path = transport._land_arrays(texts, f"{tmp_path}/a", rows=100)
    files = [json.loads(p.read_text()) for p in (tmp_path / "a").glob("part-*") if p.stat().st_size]
    assert sorted(r["id"] for rows in files for r in rows) == list(range(n))
    assert len(files) == 3 if n == 250 else len(files) <= 1
    got, dead = scan_json_ranges(spark, path, spark.range(0).schema, range_bytes=64)
    assert sorted(r.id for r in got.collect()) == list(range(n)) and dead.isEmpty()


def test_no_task_sorts_the_texts_at_the_borders_of_a_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "title": "x" * 200} for i in range(100)]))
    pieces = json_ranges._pieces(spark, str(tmp_path), 512)
    parts = json_ranges._parts(pieces, json_ranges._starts(pieces))
    plan = json_ranges._over_borders(parts)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "- Window [" in line]
    assert len(below) == 1 and "block#" in below[0] and "text#" not in below[0]
