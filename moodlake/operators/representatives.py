"""Representative texts of a cluster by TF-IDF fitted inside that cluster."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.functions.text import tokens
from moodlake.session import settle

# A (cluster, term) is hot when it has more than 1 in HOT_SHARE of all rows, so there
# are fewer than HOT_SHARE hot pairs at any data size: a bound for their broadcast.
HOT_SHARE = 10_000


def _counted(words: pa.Array) -> pa.Array:
    """The distinct words of each row and how often each occurs."""
    flat = words.flatten().dictionary_encode()
    many = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    kinds = max(len(flat.dictionary), 1)
    places, tf = np.unique(np.repeat(np.arange(len(many)), many) * kinds + flat.indices.to_numpy(), return_counts=True)
    row, term = np.divmod(places, kinds)
    runs = pa.StructArray.from_arrays([flat.dictionary.take(pa.array(term)), pa.array(tf.astype(np.int32))], names=["term", "tf"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *np.bincount(row, minlength=len(many))]), pa.int32()), runs)


def term_counts(docs: DataFrame, doc: str, text: str, keep: Sequence[str] = (), stop_words: Sequence[str] = ()) -> DataFrame:
    """(doc, keep..., term, tf).

    Counts inside the row, over the tokens as numbers, so neither the texts nor the tokens are shuffled.
    """
    runs = F.arrow_udf(_counted, "array<struct<term:string,tf:int>>")
    words = docs.select(doc, *keep, runs(tokens(text)).alias("_runs"))
    counted = words.select(doc, *keep, F.explode("_runs").alias("_run")).select(doc, *keep, "_run.*")
    return counted.filter(~F.col("term").isin(list(stop_words))) if stop_words else counted


def token_totals(docs: DataFrame, text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(term, n) over all texts; combined in each task before the shuffle."""
    words = docs.select(F.explode(tokens(text)).alias("term"))
    if stop_words:
        words = words.filter(~F.col("term").isin(list(stop_words)))
    return words.groupBy("term").agg(F.count("*").alias("n"))


def with_document_frequency(tf: DataFrame, doc: str, cluster: str) -> DataFrame:
    """Adds df, the number of the cluster's documents that hold the term, and cut, the logarithm of df + 1.

    Two branches. Hot terms, of which there are fewer than ``HOT_SHARE``, are joined by
    broadcast where their rows lie; most rows are such. The others are joined by a shuffle in
    which each key is small. An aggregate over the result starts in the map tasks of either.
    """
    # Written once, since it is read for either branch.
    df = settle(tf.groupBy(cluster, "term").agg(F.count("*").alias("df")), "frequencies")
    df = df.withColumn("cut", F.log(F.col("df") + F.lit(1.0)))
    is_hot = F.col("df") * F.lit(HOT_SHARE) > F.lit(tf.count())
    hot = F.broadcast(df.filter(is_hot))
    rare = tf.join(hot, [cluster, "term"], "left_anti").join(df.filter(~is_hot), [cluster, "term"])
    return tf.join(hot, [cluster, "term"]).unionByName(rare)


def document_scores(
    docs: DataFrame, doc: str, cluster: str, text: str, stop_words: Sequence[str] = ()
) -> DataFrame:
    """(doc, cluster, score); 0 for a document without any term.

    Weight is tf * (ln((1+n)/(1+df)) + 1) with n and df taken inside the cluster; the
    score is the sum of the document's weights after scaling them to unit length. The
    term counts are written once, since they are read for df and again for the sums.
    """
    sizes = docs.groupBy(cluster).agg(F.count("*").alias("_n"))
    grouped = docs.filter(F.col(cluster).isNotNull())
    counts = settle(term_counts(grouped, doc, text, [cluster], stop_words), "terms")
    counted = with_document_frequency(counts, doc, cluster)
    no_terms = docs.select(doc, cluster, F.lit(0).alias("tf"), F.lit(0.0).alias("cut"))
    # With A = ln(1+n)+1 a weight is tf*(A - ln(1+df)), so five sums per document are
    # enough and the cluster size joins one row per document, not one per term.
    t, cut = F.col("tf").cast("double"), F.col("cut")
    sums = (
        counted.select(doc, cluster, "tf", "cut").unionByName(no_terms).groupBy(doc, cluster)
        .agg(
            F.sum(t).alias("_t"), F.sum(t * cut).alias("_tc"),
            F.sum(t * t).alias("_tt"), F.sum(t * t * cut).alias("_ttc"), F.sum(t * t * cut * cut).alias("_ttcc"),
        )
    )
    a = F.log(F.col("_n") + F.lit(1.0)) + F.lit(1.0)
    total = a * F.col("_t") - F.col("_tc")
    length = F.sqrt(a * a * F.col("_tt") - a * F.lit(2.0) * F.col("_ttc") + F.col("_ttcc"))
    score = F.when(F.col("_t") > 0, total / length).otherwise(F.lit(0.0))
    return sums.join(sizes, cluster).select(doc, cluster, score.alias("score"))


def representative_texts(
    docs: DataFrame, doc: str, cluster: str, text: str, top_n: int = 5, stop_words: Sequence[str] = (),
) -> DataFrame:
    """(cluster, rank, doc, score, text): the ``top_n`` best documents of each cluster.

    Ties go to the smaller document id; scores equal to nine decimals are ties. A
    cluster without any term has its first document alone. The winners are written to
    the scratch folder before their texts are fetched: then their size is known, and
    Spark need not shuffle every text for the sake of a few rows.
    """
    best = Window.partitionBy(cluster).orderBy(F.desc(F.round("score", 9)), doc)
    top = (
        document_scores(docs, doc, cluster, text, stop_words)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top_n)
        .withColumn("_best", F.max("score").over(Window.partitionBy(cluster)))
        .filter((F.col("_best") > 0) | (F.col("rank") == 1))
        .select(cluster, "rank", doc, "score")
    )
    return settle(top, "representatives").join(docs.select(doc, text), doc).select(cluster, "rank", doc, "score", text)
