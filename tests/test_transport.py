"""Readers and sinks on hand-made files."""

import json
import os
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake import schemas
from moodlake.operators.dedup import keep_first, keep_first_text, union_batches
from moodlake.session import scratch_root
from moodlake.sources import readers, writers

NAMES = schemas.NEWS_COLUMNS


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_feed_of_three_widths(spark, tmp_path):
    for width in (28, 27, 26):
        write(tmp_path / f"{width}.tsv", "\t".join(f"v{i}" for i in range(width)) + "\n")
    rows, dead = readers.scan_feed(spark, str(tmp_path), NAMES)
    got = sorted(r.OriginalXML or "" for r in rows.collect())
    assert rows.columns == list(NAMES) and got == ["", "v27"]
    bad = dead.collect()
    assert [r.error for r in bad] == ["expected 28 columns, found 26"] and bad[0].file.endswith("26.tsv")
    assert rows.count() == 2 and dead.count() == 1
    assert rows.select("DATE").count() == 2 and dead.select("error").count() == 1


def test_feed_nulls_quotes_and_blank_fields(spark, tmp_path):
    path = write(tmp_path / "f.tsv", 'a\t\tNA\nb\t"x\ty"\tNaN\n')
    rows, dead = readers.scan_feed(spark, path, ["k", "v", "w"])
    assert sorted(tuple(r) for r in rows.collect()) == [("a", None, None), ("b", "x\ty", None)]
    assert dead.isEmpty()


def test_name_by_width(spark):
    df = spark.createDataFrame([("1", "2")], "x string, y string")
    assert readers.name_by_width(df, ["a", "b"]).columns == ["a", "b"]
    assert readers.name_by_width(df, ["a", "b", "c"]).columns == ["a", "b"]
    assert readers.name_by_width(df, ["a"]).columns == ["Column_0", "Column_1"]


def test_wide_rows_become_dead_letters(spark, tmp_path):
    path = write(tmp_path / "w.tsv", "a\tb\tc\td\ne\tf\ng\n")
    rows, dead = readers.scan_tsv(spark, path, 2)
    assert sorted(tuple(r) for r in rows.collect()) == [("e", "f"), ("g", None)]
    assert [(r.error, r.record) for r in dead.collect()] == [("expected 2 columns, found 4", "a\tb\tc\td")]
    assert readers.tsv_width(spark, path) == 4


def test_zip_reads_every_member_of_any_width(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("27.csv", "\t".join(f"v{i}" for i in range(27)) + "\n")
        z.writestr("29.csv", "\t".join(f"w{i}" for i in range(28)) + "\n" + "\t".join(f"x{i}" for i in range(29)) + "\n")
    rows = readers.scan_zipped_tsv(spark, str(tmp_path), 28).collect()
    assert sorted((r.member, r._c0, r._c27) for r in rows if r.error is None) == [("27.csv", "v0", None), ("29.csv", "w0", "w27")]
    assert [(r.member, r.error[:29]) for r in rows if r.error] == [("29.csv", "expected 28 columns, found 29")]


def test_zip_isolates_bad_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("one.csv", "1\ta\n2\tb\n")
        z.writestr("two.csv", "3\tc\n")
    (tmp_path / "bad.zip").write_bytes(b"not a zip")
    rows = readers.scan_zipped_tsv(spark, str(tmp_path), 2).collect()
    assert sorted((r._c0, r._c1) for r in rows if r.error is None) == [("1", "a"), ("2", "b"), ("3", "c")]
    assert [r.error.split(":")[0] for r in rows if r.error] == ["BadZipFile"]


def test_json_array_nan_and_truncated_file(spark, tmp_path):
    write(tmp_path / "good.json", '[{"id": "1", "title": NaN, "score": 3}, {"id": "2", "title": "t", "extra": 1}]')
    write(tmp_path / "cut.json", '[{"id": "3", "title"')
    schema = T.StructType([schemas.POSTS["id"], schemas.POSTS["title"], schemas.POSTS["score"]])
    rows, dead = readers.scan_json_array(spark, str(tmp_path), schema, nan_columns=["title"])
    assert sorted((r.id, r.title, r.score) for r in rows.collect()) == [("1", None, 3), ("2", "t", None)]
    kept, _ = readers.scan_json_array(spark, str(tmp_path), schema)
    assert {r.title for r in kept.collect()} == {"NaN", "t"}
    assert rows.count() == 2 and dead.count() == 1
    assert dead.first().file.endswith("cut.json")


def test_text_array_keeps_positions(spark, tmp_path):
    write(tmp_path / "good.json", '["b", "a\\n", "b"]')
    write(tmp_path / "cut.json", '["b", "a')
    rows, dead = readers.scan_text_array(spark, str(tmp_path))
    assert sorted((r.position, r.text) for r in rows.collect()) == [(0, "b"), (1, "a\n"), (2, "b")]
    assert [r.file.endswith("cut.json") for r in dead.collect()] == [True]


POST = "id string, text string, group string, date date"


def posts(spark, rows):
    return spark.createDataFrame(rows, POST)


def test_partitions_missing_and_pruned(spark, tmp_path):
    df = posts(spark, [("1", "a", "g1", date(2024, 1, 1)), ("2", "b", "g2", date(2024, 1, 2))])
    root = str(tmp_path / "t")
    writers.write_texts(df, root)
    got = readers.read_partition(spark, root, df.schema, group="g1", date="2024-01-01")
    assert [r.id for r in got.collect()] == ["1"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    one = readers.read_partition(spark, root, df.schema, date="2024-01-01", group="g1")
    assert one.inputFiles() and all("date=2024-01-01/group=g1" in f for f in one.inputFiles())
    assert readers.read_partition(spark, root, df.schema, date="2024-05-01").isEmpty()
    assert readers.read_partition(spark, root + "/absent", df.schema, date="2024-05-01").isEmpty()
    for missing in (root, root + "/absent"):
        with pytest.raises(FileNotFoundError):
            readers.read_partition(spark, missing, df.schema, on_missing="raise", date="2024-05-01")
    with pytest.raises(ValueError):
        readers.read_partition(spark, root, df.schema, on_missing="ignore")
    rows, counts = readers.scan_groups(spark, root, df.schema, ["g1", "g3", "g1"], "group")
    assert rows.count() == 1 and {r.group: r.n_rows for r in counts.collect()} == {"g1": 1, "g3": 0}


def test_dates_in_the_root_do_not_count(spark, tmp_path):
    root = tmp_path / "2020-01-01" / "series"
    write(root / "2024-05-05" / "data.csv", "x\n")
    for form in (str(root), f"file://{root}"):
        assert [r.date for r in readers.available_dates(spark, form).collect()] == [date(2024, 5, 5)]


def test_available_dates_skips_other_folders(spark, tmp_path):
    for name in ("2024-01-02", "date=2024-01-05", "latest", "2024-13-01"):
        write(tmp_path / name / "data.csv", "x\n")
    got = [r.date for r in readers.available_dates(spark, str(tmp_path)).collect()]
    assert got == [date(2024, 1, 5), date(2024, 1, 2)]


@pytest.mark.parametrize("rewrite", [False, True])
def test_upsert_keeps_stored_rows_and_is_idempotent(spark, tmp_path, rewrite):
    d1, d2, d3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
    root = str(tmp_path / "store")
    first = posts(spark, [("1", "old", "g", d1), ("9", "other day", "g", d3)])
    new = posts(spark, [("1", "new", "g", d1), ("2", "b first", "g", d1), ("2", "c later", "g", d1), ("1", "same id, next day", "g", d2)])
    writers.upsert_keep_existing(first, root, "id", ["text"], rewrite=rewrite)
    want = {("1", "old", d1), ("2", "b first", d1), ("1", "same id, next day", d2), ("9", "other day", d3)}
    for _ in range(2):
        writers.upsert_keep_existing(new, root, "id", ["text"], rewrite=rewrite)
        got = spark.read.schema(first.schema).parquet(root).collect()
        assert len(got) == 4 and {(r.id, r.text, r.date) for r in got} == want


def test_rewrite_keeps_columns_that_only_the_store_has(spark, tmp_path):
    d, root = date(2024, 1, 1), str(tmp_path / "store")
    old = spark.createDataFrame([("1", "old", 7, d)], "id string, text string, extra int, date date")
    writers.upsert_keep_existing(old, root, "id", ["text"])
    writers.upsert_keep_existing(posts(spark, [("2", "new", "g", d)]), root, "id", ["text"], rewrite=True)
    got = {(r.id, r.extra, r.group) for r in spark.read.parquet(root).collect()}
    assert got == {("1", 7, None), ("2", None, "g")}


def test_json_of_one_day_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        writers.write_json(posts(spark, [("1", "a", "g", day)]), path, ["date"])
    assert sorted(p for p in os.listdir(path) if p.startswith("date=")) == ["date=2024-01-01", "date=2024-01-02"]


def test_dead_letters_only_when_there_are_some(spark, tmp_path):
    df = spark.createDataFrame([("g", "1", None), ("g", "2", "boom")], "group string, id string, error string")
    good, dead = writers.split_failures(df)
    path = str(tmp_path / "dead")
    assert writers.write_dead_letters(dead.filter("false"), path) is False and not os.path.exists(path)
    assert writers.write_dead_letters(dead, path) is True
    assert good.columns == ["group", "id"] and spark.read.json(path).first().error == "boom"


def test_csv_rounds_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([('http://a/?q="x",y\nz', 0.12349)], "url string, score double")
    writers.write_csv(df, str(tmp_path / "c"))
    back = spark.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "c"))
    assert tuple(back.first()) == ('http://a/?q="x",y\nz', 0.123)


def test_json_keeps_nulls_and_unicode(spark, tmp_path):
    path = tmp_path / "j"
    writers.write_json(spark.createDataFrame([("é", None)], "a string, b string").coalesce(1), str(path))
    text = next(path.glob("*.json")).read_text(encoding="utf-8")
    assert json.loads(text) == {"a": "é", "b": None} and "é" in text


def test_keep_first_is_idempotent_and_ordered(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 3, "c"), (None, 4, "d")], "key string, at int, v string")
    once = keep_first(df, ["key"], ["at"])
    assert {(r.key, r.v) for r in once.collect()} == {("k", "a"), (None, "c")}
    assert keep_first(once, ["key"], ["at"]).count() == 2
    texts = spark.createDataFrame([(1, "x"), (2, "x"), (3, "X")], "id int, t string")
    assert sorted(r.id for r in keep_first_text(texts, "t", ["id"]).collect()) == [1, 3]


def test_union_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "s")], "x int, y string")
    assert {(r.x, r.y) for r in union_batches(a, b, a).collect()} == {(1, None), (2, "s")}
    assert union_batches(a, b, a).count() == 3


def test_scratch_is_the_configured_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_embeddings_are_floats(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 1.5])], "id long, v array<double>").withColumn("extra", F.lit(1))
    writers.write_embeddings(df, str(tmp_path / "e"), "id", "v")
    back = spark.read.parquet(str(tmp_path / "e"))
    assert back.dtypes == [("id", "bigint"), ("v", "array<float>")] and back.first().v == [0.5, 1.5]
