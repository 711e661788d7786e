"""Embeddings, K-means with restarts, silhouettes and the cluster report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodlake.functions.hashing import unit_counts
from moodlake.functions.text import truncate
from moodlake.operators.representatives import representative_texts


def embed_hashing(df: DataFrame, text: str, dims: int = 256, out: str = "embedding") -> DataFrame:
    """Adds a unit vector of hashed word counts; all zero for a text without words, null for a null one.

    A word's place is its MD5 modulo ``dims``, which other engines can repeat.
    """

    @F.pandas_udf("array<float>")
    def vector(texts: pd.Series) -> pd.Series:
        made = []
        for t in texts:
            v = None
            if t is not None:
                v = np.zeros(dims, np.float32)
                at, weights = unit_counts(t, dims)
                v[at] = weights
            made.append(v)
        return pd.Series(made, dtype=object)

    return df.withColumn(out, vector(F.lower(F.col(text))))


def embed_model(
    df: DataFrame, text: str, make_predict: Callable[[], Callable], batch: int = 32, out: str = "embedding"
) -> DataFrame:
    """Adds the vectors of a sentence-embedding model, ``batch`` texts per call.

    ``make_predict`` loads the model, once per Python worker, and returns a function
    from an array of texts to a 2-D array of floats.
    """
    embed = predict_batch_udf(make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=batch)
    return df.withColumn(out, embed(F.col(text)))


def as_features(df: DataFrame, embedding: str = "embedding") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(embedding).cast("array<double>")))


INIT_ROWS = 4096


@dataclass(frozen=True)
class Centres:
    """A fitted K-means: the centres, the sizes of their clusters and the summed squared distances."""

    centres: np.ndarray
    sizes: np.ndarray
    cost: float

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return _gaps(x, self.centres).argmin(1)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)


@contextmanager
def _kept(df: DataFrame, embedding: str) -> Iterator[DataFrame]:
    """Hold the vectors while passes go over them; spills to disk, and a lost block is computed
    again from its source."""
    vectors = df.select(F.col(embedding).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    held = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _first_centres(sample: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """K-means++ on the weighted sample: each next centre is drawn by its squared distance to the others."""
    draw = np.random.default_rng(seed)
    chosen = [sample[draw.choice(len(sample), p=weight / weight.sum())]]
    gap = _gaps(sample, np.array(chosen))[:, 0]
    for _ in range(k - 1):
        share = gap * weight if (gap * weight).sum() > 0 else weight
        at = draw.choice(len(sample), p=share / share.sum())
        chosen.append(sample[at])
        gap = np.minimum(gap, _gaps(sample, sample[at : at + 1])[:, 0])
    return np.array(chosen)


def _sample(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``INIT_ROWS`` distinct vectors, drawn by their copies without return, and their weights.

    Each distinct vector waits a time drawn by its hash at a rate of its copies; the first ones
    are taken. A weight is the copies over the chance to be taken: the copies themselves where
    all are taken. Hashes and counts are shuffled, and only drawn vectors are moved.
    """
    hashes = [F.xxhash64("v").alias("h"), F.xxhash64(F.lit("second"), "v").alias("h2")]
    counts = vectors.groupBy(*hashes).agg(F.count("*").alias("n"))
    place = (F.pmod(F.xxhash64(F.lit("wait"), "h", "h2"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    waits = counts.withColumn("wait", -F.log(place) / F.col("n"))
    first = waits.orderBy("wait", "h", "h2").limit(INIT_ROWS + 1).collect()
    taken, until = first[:INIT_ROWS], first[INIT_ROWS].wait if len(first) > INIT_ROWS else np.inf
    wanted = vectors.sparkSession.createDataFrame([(r.h, r.h2) for r in taken], "h long, h2 long")
    found = vectors.select("v", *hashes).join(F.broadcast(wanted), ["h", "h2"]).groupBy("h", "h2").agg(F.first("v").alias("v")).collect()
    of = {(r.h, r.h2): r.v for r in found}
    drawn = sorted((list(of[r.h, r.h2]), r.n / -np.expm1(-r.n * until)) for r in taken)
    return np.array([v for v, _ in drawn]), np.array([w for _, w in drawn])


def _sums(vectors: DataFrame, runs: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, float, float, np.ndarray]]:
    """(count, summed distance, summed squares, summed vectors) of each cluster of each run.

    One pass for all runs. A task sends one row per run and cluster; the driver gets as many,
    a number set by the parameters alone.
    """
    starts = np.cumsum([0, *(len(c) for c in runs)])
    stacked = np.concatenate(runs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, cost, square, total = (np.zeros(s) for s in (len(stacked), len(stacked), len(stacked), stacked.shape))
        for frame in frames:
            x = np.stack(frame["v"].to_numpy())
            gaps, size = _gaps(x, stacked), (x**2).sum(1)
            for low, high in zip(starts, starts[1:]):
                own = gaps[:, low:high].argmin(1)
                hot = np.zeros((len(x), high - low))
                hot[np.arange(len(x)), own] = 1
                n[low:high] += hot.sum(0)
                cost[low:high] += hot.T @ gaps[np.arange(len(x)), low + own]
                square[low:high] += hot.T @ size
                total[low:high] += hot.T @ x
        full = np.flatnonzero(n)
        if len(full):  # a task may have no rows
            yield pd.DataFrame({"at": full, "n": n[full].astype(int), "cost": cost[full], "square": square[full], "total": list(total[full])})

    parts = vectors.mapInPandas(run, "at int, n long, cost double, square double, total array<double>")
    parts = parts.withColumn("total", array_to_vector("total"))
    rows = parts.groupBy("at").agg(F.sum("n"), F.sum("cost"), F.sum("square"), Summarizer.sum(F.col("total"))).collect()
    out = {}
    for at, n, cost, square, total in rows:
        r = int(np.searchsorted(starts, at, "right")) - 1
        out[r, at - int(starts[r])] = (n, cost, square, total.toArray())
    return out


def _fit_all(vectors: DataFrame, jobs: list[tuple[int, int]], max_iter: int, tol: float = 1e-9) -> list[Centres]:
    """A fit for each ``(k, seed)``. All fits that have not settled move on in the same pass, so
    there are as many passes as the slowest fit has iterations, whatever the number of fits.

    Starts are drawn from at most ``INIT_ROWS`` distinct vectors, weighted by their copies; the
    fits use all.
    """
    if vectors.isEmpty():
        raise ValueError("no vectors to cluster")
    drawn, weight = _sample(vectors)
    centres = [_first_centres(drawn, weight, k, seed) for k, seed in jobs]
    mean = np.average(drawn, axis=0, weights=weight)
    scale = max(float(np.average(((drawn - mean) ** 2).sum(1), weights=weight)), 1e-30)
    active = list(range(len(jobs)))
    for _ in range(max_iter):
        sums = _sums(vectors, [centres[j] for j in active])
        moved = []
        for r, j in enumerate(active):
            new = centres[j].copy()
            for c in range(len(new)):
                if (r, c) in sums:
                    new[c] = sums[r, c][3] / sums[r, c][0]
            if ((new - centres[j]) ** 2).sum(1).max() > tol * scale:
                moved.append(j)
            centres[j] = new
        active = moved
        if not active:
            break
    sums = _sums(vectors, centres)
    out = []
    for j, c in enumerate(centres):
        parts = [sums.get((j, i), (0, 0.0)) for i in range(len(c))]
        out.append(Centres(c, np.array([p[0] for p in parts]), float(sum(p[1] for p in parts))))
    return out


def _cheapest(fits: list[Centres]) -> Centres:
    """The fit with the least cost, the first on a tie; nine digits, since the last ones change
    with the order in which tasks are summed."""
    return min(fits, key=lambda f: float(f"{f.cost:.9g}"))


def fit_kmeans(
    df: DataFrame, k: int, embedding: str = "embedding", starts: int = 10, seed: int = 42, max_iter: int = 300
) -> Centres:
    """K-means, best of several starts."""
    with _kept(df, embedding) as vectors:
        return _cheapest(_fit_all(vectors, [(k, seed + i) for i in range(starts)], max_iter))


def assign(model: Centres, df: DataFrame, embedding: str = "embedding") -> DataFrame:
    """Adds the cluster of each row, null for a null vector; one pass, no shuffle."""

    @F.pandas_udf("int")
    def cluster(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), dtype="Int32")
        known = vectors.notna().to_numpy()
        if known.any():
            out[known] = model.nearest(np.stack(vectors[known].to_numpy()).astype(float))
        return out

    return df.withColumn("cluster", cluster(F.col(embedding).cast("array<double>")))


@dataclass(frozen=True)
class BestK:
    k: int
    model: Centres
    scores: dict[int, float]


def best_k(
    df: DataFrame, ks: Iterable[int] = range(3, 11), embedding: str = "embedding", starts: int = 10, seed: int = 42,
    max_iter: int = 300,
) -> BestK:
    """The k with the highest silhouette; the smaller k on a tie.

    All starts of all k move together, one pass an iteration. Uses the squared-Euclidean
    silhouette, which needs only the sums of the clusters: two more passes for all k.
    """
    ks = sorted(set(ks))
    with _kept(df, embedding) as vectors:
        fits = _fit_all(vectors, [(k, seed + i) for k in ks for i in range(starts)], max_iter)
        models = {k: _cheapest(fits[i * starts : (i + 1) * starts]) for i, k in enumerate(ks)}
        scores = dict(zip(ks, _silhouettes(vectors, [models[k].centres for k in ks])))
    chosen = max(ks, key=lambda k: (round(scores[k], 12), -k))
    return BestK(chosen, models[chosen], scores)


def _silhouettes(vectors: DataFrame, runs: list[np.ndarray]) -> list[float]:
    """Mean squared-Euclidean silhouette of each clustering, all in one pass after the sums; -1
    where fewer than two clusters have rows."""
    sums = _sums(vectors, runs)
    stats = []
    for r, c in enumerate(runs):
        have = [i for i in range(len(c)) if (r, i) in sums]
        n, _, square, total = (np.array([sums[r, i][k] for i in have]) for k in range(4))
        stats.append((c[have], n, square, total))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, value = 0, np.zeros(len(stats))
        for frame in frames:
            x = np.stack(frame["v"].to_numpy())
            rows += len(x)
            for r, (c, n, square, total) in enumerate(stats):
                if len(n) < 2:
                    continue
                own = _gaps(x, c).argmin(1)
                far = np.maximum((x**2).sum(1)[:, None] * n - 2 * x @ total.T + square, 0)
                at = np.arange(len(x))
                inside = far[at, own] / np.maximum(n[own] - 1, 1)
                far /= n
                far[at, own] = np.inf
                outside = far.min(1)
                top = np.maximum(inside, outside)
                value[r] += np.where((n[own] > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0).sum()
        yield pd.DataFrame({"r": range(len(stats)), "value": value, "rows": rows})

    parts = vectors.mapInPandas(run, "r int, value double, rows long")
    got = {r.r: r.v / r.n for r in parts.groupBy("r").agg(F.sum("value").alias("v"), F.sum("rows").alias("n")).collect()}
    return [got[r] if len(s[1]) > 1 else -1.0 for r, s in enumerate(stats)]


def _evaluator(cluster: str) -> ClusteringEvaluator:
    return ClusteringEvaluator(
        predictionCol=cluster, featuresCol="features", metricName="silhouette", distanceMeasure="squaredEuclidean"
    )


def silhouette_squared(df: DataFrame, cluster: str, embedding: str = "embedding") -> float:
    """Mean silhouette with squared Euclidean distance; linear in the rows."""
    return _evaluator("_c").evaluate(as_features(df, embedding).select("features", F.col(cluster).cast("double").alias("_c")))


def cluster_sizes(df: DataFrame, cluster: str, n_clusters: int | None = None) -> DataFrame:
    """(cluster, size, percentage). With ``n_clusters`` also the empty ones of 0..n-1."""
    sizes = df.groupBy(cluster).agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).scalar()
    if n_clusters is not None:
        every = df.sparkSession.range(n_clusters).select(F.col("id").cast(df.schema[cluster].dataType).alias(cluster))
        sizes = every.join(sizes, cluster, "left").withColumn("size", F.coalesce("size", F.lit(0)))
    return sizes.withColumn("percentage", F.coalesce(F.try_divide(F.col("size") * F.lit(100.0), total), F.lit(0.0)))


def cluster_group_counts(df: DataFrame, cluster: str, group: str) -> DataFrame:
    """(cluster, group, n): the group distribution in long form."""
    return df.groupBy(cluster, group).agg(F.count("*").alias("n"))


def cluster_group_map(df: DataFrame, cluster: str, group: str) -> DataFrame:
    """(cluster, group_distribution) as a map in group order. Rows are counted before
    they are collected, so an entry list is as long as there are groups."""
    entries = F.sort_array(F.collect_list(F.struct(group, "n")))
    return cluster_group_counts(df, cluster, group).groupBy(cluster).agg(
        F.map_from_entries(entries).alias("group_distribution")
    )


def cluster_report(
    df: DataFrame, doc: str, cluster: str, group: str, text: str, preview: int = 100, stop_words: Sequence[str] = (),
    n_clusters: int | None = None,
) -> DataFrame:
    """(cluster, size, percentage, representative preview, group_distribution)."""
    first = representative_texts(df, doc, cluster, text, top_n=1, stop_words=stop_words)
    return (
        cluster_sizes(df, cluster, n_clusters)
        .join(first.select(cluster, truncate(text, preview).alias("representative")), cluster, "left")
        .join(cluster_group_map(df, cluster, group), cluster, "left")
        .withColumn("representative", F.coalesce("representative", F.lit("")))
    )
