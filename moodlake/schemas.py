"""Record layouts read and written by the jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The public column order of the global knowledge graph feed, version 2.1,
# and a 28th name that its layout does not have.
NEWS_COLUMNS = (
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes", "Locations",
    "V2Locations", "Persons", "V2Persons", "Organizations", "V2Organizations", "Tone",
    "Dates", "GCAM", "SharingImage", "RelatedImages", "SocialImageEmbeds",
    "SocialVideoEmbeds", "Quotations", "AllNames", "Amounts", "TranslationInfo",
    "Extras", "OriginalXML",
)

# What pandas.read_csv takes for a missing value (its documented default).
PANDAS_NA_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


NEWS = strings(NEWS_COLUMNS)

NEWS_MIN = strings(("DATE", "DocumentIdentifier", "SourceCommonName", "V2Themes", "Tone"))

POSTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("created_utc", T.TimestampType()),
        T.StructField("score", T.LongType()),
    ]
)

SCORE_FIELDS = (
    T.StructField("label", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("error", T.StringType()),
)


def null_tokens(df: DataFrame, tokens: Iterable[str] = ("NaN",)) -> DataFrame:
    """Turn the given spellings of "missing" into null in every string column."""
    tokens = list(tokens)
    if not tokens:
        return df
    return df.select(
        *[
            F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
