"""The clustering job from texts to report and stored assignments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.operators import text_clusters
from moodlake.operators.clustering import BestK, cluster_report
from moodlake.session import settle


@dataclass(frozen=True)
class TextClusters:
    """The fit, the stored assignments and the report made from them."""

    best: BestK
    assigned: DataFrame
    report: DataFrame


def cluster_texts(
    docs: DataFrame, path: str, doc: str, group: str, text: str, vectors: DataFrame, dims: int, ks: Iterable[int] = range(3, 11),
    stop_words: Sequence[str] = (), preview: int = 100, starts: int = 10, seed: int = 42, max_iter: int = 300,
) -> TextClusters:
    """Fit on ``vectors`` (key, places, weights), write ``(key, group, cluster)`` to ``path`` in folders
    by cluster, and report on the stored assignments.

    The key is that of ``docs``; texts are joined by it and are not stored again. A text without
    a vector has no cluster and is left out of both. The vectors are written once, for the fit and the assignments.
    """
    vectors = settle(vectors.select(doc, "places", "weights"), "text-vectors")
    best = text_clusters.best_k(vectors, dims, ks, starts=starts, seed=seed, max_iter=max_iter)
    found = text_clusters.assign(best.model, vectors).filter("cluster is not null").select(doc, "cluster")
    keyed = docs.select(doc, group).join(found, doc)
    # A few tasks a cluster, however large it is.
    keyed.hint("rebalance", "cluster").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cluster").parquet(path)
    schema = f"`{doc}` {docs.schema[doc].dataType.simpleString()}, `{group}` {docs.schema[group].dataType.simpleString()}, cluster int"
    assigned = docs.sparkSession.read.schema(schema).parquet(path)
    whole = docs.select(doc, text).join(assigned, doc)
    report = cluster_report(whole, doc, "cluster", group, text, preview, stop_words)
    return TextClusters(best, assigned, report)
