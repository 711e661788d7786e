"""What the training-data operators share: session settings, scratch tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.session import scratch_path

ARROW_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the rows that a Python worker holds at once; a text may be 100 KB and more."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: survives lost executors, cuts lineage."""
    path = scratch_path(df.sparkSession, f"llm-{purpose}-{uuid.uuid4().hex[:8]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_part(c: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) % parts


def sampled(c: str, share: Column | float) -> Column:
    """A repeatable draw by the hash of the id; ``share`` is the expected part kept."""
    draw = F.pmod(F.xxhash64(F.lit("draw"), F.col(c)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return draw < share


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest node reachable from each node, as ``(node, component)``.

    ``edges`` has two long columns ``a`` and ``b``; self-loops and repeats do no harm, and a
    node without an edge is not returned. Large-star and small-star steps alternate until
    the edge set stays the same. Every round is written to the shared folder, so neither
    lineage nor the driver grows with the data: the driver sees one checksum a round.
    """
    pair = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = edges.filter("a <> b").select(pair.alias("e")).select("e.*").distinct()
    now = settle(now, purpose)
    seen = _checksum(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settle(small.unionAll(low.select("a", F.col("m").alias("b"))).distinct(), purpose)
        last, seen = seen, _checksum(now)
        if seen == last:
            break
    centres = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(centres)


def _checksum(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.pmod(h, F.lit(1 << 31)))).first())
