"""JSON arrays of any size, read in ranges of bytes.

A reader of whole files makes one array one task. Here Spark cuts a file into its usual ranges and the
ranges at every ``}``, so that a record can only end where a piece does. Whether that ``}`` ends one depends
on all the text before it, which is carried by a prefix scan: a piece turns (inside a string, depth)
into another such state, a range composes its pieces, and a window over the ranges of a file, one
row each, gives the state in which each range starts. Records are then put together range by
range; those over a border are joined from their parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.session import scratch_path, settle

_BAD = "_corrupt_record"
_NOT_ARRAY = "not a JSON array of records"


def scan_json_ranges(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    nan_columns: Sequence[str] = (),
    range_bytes: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Files that each hold one JSON array of objects, split by ranges of bytes: (rows, dead letters).

    A file that is not such an array gives one dead letter ``(file, error, record)`` and no rows; the
    record is the first bad one, or null where the end of the array is missing (then no part of the
    file is put together). An empty array gives neither, nor does a file of no bytes, which Spark does
    not list. JSON is read strictly but for a bare ``NaN``, which becomes null in ``nan_columns`` and the text "NaN" elsewhere.
    A record must fit into a row. ``range_bytes`` is the size of a range, by default the session's
    ``spark.sql.files.maxPartitionBytes``. The files are read once.
    """
    pieces = _pieces(spark, path, range_bytes)
    starts = _starts(pieces)
    parts = _parts(pieces, starts)
    whole = F.col("starts") & F.col("ends")
    inside = parts.filter(whole).select("file", "block", "record", "text", "ends")
    records = inside.unionByName(_over_borders(parts.filter(~whole)))

    first = (F.col("block") == 0) & (F.col("record") == 0)
    lead = F.when(first, r"^\x{FEFF}?\s*+\[\s*+(?=\{)").otherwise(r"^\s*+,\s*+(?=\{)")
    tail = F.when(first, r"^\x{FEFF}?\s*+\[\s*+\]\s*+\}\z").otherwise(r"^\s*+\]\s*+\}\z")
    with_bad = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "allowSingleQuotes": "false"}
    body = F.when(F.regexp_like("text", lead), _quoted_nan(F.regexp_replace("text", lead, F.lit(""))))
    parsed = records.withColumn("row", F.when(F.col("ends"), F.from_json(body, with_bad, options)))
    good = F.when(F.col("ends"), F.col("row").isNotNull() & F.col(f"row.{_BAD}").isNull()).otherwise(F.regexp_like("text", tail))

    place = F.struct("block", "record")
    broken = parsed.filter(~good).groupBy("file").agg(F.min_by("text", place).alias("record"))
    open_files = starts.filter(~F.col("closed")).select("file").distinct()
    none = F.lit(None).cast("string")
    dead = settle(
        broken.select("file", F.lit(_NOT_ARRAY).alias("error"), "record").unionByName(
            open_files.select("file", F.lit("the JSON array does not end").alias("error"), none.alias("record"))
        ),
        "json-dead",
    )
    rows = parsed.filter("ends").join(dead.select("file"), "file", "left_anti").select("row.*")
    plain = [F.when(F.col(c) != "NaN", F.col(c)).alias(c) if c in nan_columns else F.col(c) for c in schema.names]
    return rows.select(*plain), dead


def _quoted_nan(text: Column) -> Column:
    """Bare ``NaN`` as the text "NaN"; strings are stepped over, one match after the other."""
    bare = r'\G((?:[^"N]++|"(?:[^"\\]++|\\.)*+"|N(?!aN))*+)NaN'
    return F.when(text.contains("NaN"), F.regexp_replace(text, bare, '$1"NaN"')).otherwise(text)


def _depth_change(text: Column) -> Column:
    """Opened less closed brackets outside strings, of a text without escapes."""
    outside = F.regexp_replace(text, r'"[^"]*+(?:"|\z)', "")
    return F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"[\]}]"))


def _pieces(spark: SparkSession, path: str | list[str], range_bytes: int | None) -> DataFrame:
    """The text up to each ``}``, in order ``seq`` of its range, with what it does to the state.

    ``flips``: the quotes in it are odd. ``from_out`` and ``from_in``: the change of depth, its ``}`` included,
    if it starts outside or inside a string. Backslashes stand only in strings and never before
    a ``}`` alone, so an escape is never cut. Written, because a second scan of the files may be
    cut into other ranges.
    """
    reader = spark
    if range_bytes is not None:  # a session of its own leaves the caller's setting alone
        reader = spark.newSession()
        reader.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    raw = reader.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    bare = raw.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    flips = F.pmod(F.regexp_count("bare", F.lit('"')), F.lit(2)).alias("flips")
    # The closing bracket counts where the piece ends outside a string.
    from_out = _depth_change(F.concat("bare", F.lit("}"))).alias("from_out")
    from_in = _depth_change(F.concat(F.lit('"'), "bare", F.lit("}"))).alias("from_in")
    pieces = bare.select("file", "block", "seq", "value", flips, from_out, from_in)
    written = scratch_path(spark, "json-pieces")
    pieces.write.parquet(written)
    return spark.read.schema(pieces.schema).parquet(written)


def _running(pieces: DataFrame) -> DataFrame:
    """Per piece the quotes before it in its range, modulo two."""
    before = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("flipped", F.pmod(F.coalesce(F.sum("flips").over(before), F.lit(0)), F.lit(2)))


def _starts(pieces: DataFrame) -> DataFrame:
    """Per range the state in which it starts, and whether its file ends where an array does.

    The numbers of the pieces are shuffled, not their texts; what is left is one row a range.
    """
    swapped = F.col("flipped") == 1
    ranges = _running(pieces.select("file", "block", "seq", "flips", "from_out", "from_in")).groupBy("file", "block").agg(
        F.pmod(F.sum("flips"), F.lit(2)).alias("flips"),
        F.sum(F.when(swapped, F.col("from_in")).otherwise(F.col("from_out"))).alias("from_out"),
        F.sum(F.when(swapped, F.col("from_out")).otherwise(F.col("from_in"))).alias("from_in"),
    )
    by_file = Window.partitionBy("file").orderBy("block")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    known = ranges.withColumn("in_string", F.pmod(F.coalesce(F.sum("flips").over(before), F.lit(0)), F.lit(2)))
    known = known.withColumn("change", F.when(F.col("in_string") == 1, F.col("from_in")).otherwise(F.col("from_out")))
    every = Window.partitionBy("file")
    # The last piece of a file has no closing bracket of its own: the one counted for it ends at -1.
    closed = (F.sum("change").over(every) == -1) & (F.pmod(F.sum("flips").over(every), F.lit(2)) == 0)
    depth = F.coalesce(F.sum("change").over(before), F.lit(0))
    return settle(known.select("file", "block", "in_string", depth.alias("depth"), closed.alias("closed")), "json-ranges")


def _parts(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Records, or the parts of them that lie in one range, of files that end as an array does.

    ``record`` counts the records that ended before in the range. One shuffle of the texts, by range.
    """
    dealt = _running(pieces.select("file", "block", "seq", "value", "flips", "from_out", "from_in"))
    dealt = dealt.join(starts.filter("closed").drop("closed"), ["file", "block"])
    so_far = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.col("flipped") != F.col("in_string")
    dealt = dealt.withColumn("change", F.when(inside, F.col("from_in")).otherwise(F.col("from_out")))
    outside_after = F.pmod(F.col("flipped") + F.col("in_string") + F.col("flips"), F.lit(2)) == 0
    ends = outside_after & (F.col("depth") + F.sum("change").over(so_far) == 1)
    dealt = dealt.withColumn("ends", ends)
    dealt = dealt.withColumn("record", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    in_order = F.array_sort(F.collect_list(F.struct("seq", "value")))
    parts = dealt.groupBy("file", "block", "record").agg(
        F.concat(F.array_join(F.transform(in_order, lambda p: p["value"]), "}"), F.lit("}")).alias("text"),
        F.max("ends").alias("ends"),
        F.max((F.col("in_string") == 0) & (F.col("depth") == 1)).alias("at_border"),
    )
    starts_here = (F.col("record") > 0) | (F.col("block") == 0) | F.col("at_border")
    return settle(parts.withColumn("starts", starts_here).drop("at_border"), "json-parts")


def _over_borders(parts: DataFrame) -> DataFrame:
    """Records joined from their parts in neighbouring ranges, at most two parts a range.

    The parts of a file are numbered in one order, without their texts; these meet the numbers by a join.
    """
    in_file = Window.partitionBy("file").orderBy("block", "record")
    place = ["file", "block", "record"]
    numbers = parts.select(*place, F.sum(F.col("starts").cast("int")).over(in_file).alias("_nth"))
    numbered = parts.select(*place, "text", "ends").join(numbers, place)
    in_order = F.array_sort(F.collect_list(F.struct("block", "record", "text")))
    joined = numbered.groupBy("file", "_nth").agg(in_order.alias("p"), F.max("ends").alias("ends"))
    text = F.array_join(F.transform("p", lambda p: p["text"]), "")
    return joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["record"].alias("record"), text.alias("text"), "ends")
