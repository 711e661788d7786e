"""Union and keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given order.

    ``row_number() = 1`` lets Spark keep the best row of each key inside every map task
    before the shuffle, so a key that holds a third of the table still sends only one
    row per task. ``dropDuplicates`` would not promise which row stays.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def keep_first_text(df: DataFrame, text: str, order: Sequence[Column | str], keys: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each distinct text.

    Groups on the text's SHA-256 so that long texts are not sort and shuffle keys.
    """
    return keep_first(df, [*keys, F.sha2(F.col(text), 256)], order)


def union_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
