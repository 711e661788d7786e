"""Clusters of texts: K-means on sparse vectors of hashed words, report and assignments.

A text is the unit vector of its hashed word counts, kept as its places and values. Rows stay
sparse in every pass; only the centres are dense, and a task sends the places that its rows
touched. Nothing grows with the number of texts but the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.functions.hashing import unit_rows
from moodlake.operators.clustering import BestK, Centres

INIT_ROWS = 4096


def hashed_places(df: DataFrame, text: str, dims: int = 4096, places: str = "places", weights: str = "weights") -> DataFrame:
    """Adds the places (ascending) and weights of a text's unit vector of hashed word counts.

    A word's place is its MD5 modulo ``dims``, as in ``embed_hashing``, but only the places that
    are not zero are kept; a distinct word is hashed once a worker. A null text has nulls, a text
    without words has empty arrays.
    """

    @F.arrow_udf("p array<int>, w array<double>")
    def vector(texts: pa.Array) -> pa.Array:
        many, at, of = unit_rows([t or "" for t in texts.to_pylist()], dims)
        ends, null = pa.array(np.cumsum([0, *many]), pa.int32()), texts.is_null()
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, pa.array(x), mask=null) for x in (at, of)], names=["p", "w"])

    made = df.withColumn("_vector", vector(F.lower(F.col(text))))
    return made.withColumn(places, F.col("_vector.p")).withColumn(weights, F.col("_vector.w")).drop("_vector")


class Rows:
    """Sparse rows of a batch."""

    def __init__(self, places: pa.Array, weights: pa.Array):
        self.many = pc.fill_null(pc.list_value_length(places), 0).to_numpy().astype(np.int64)
        self.at = places.flatten().to_numpy().astype(np.int64)
        self.w = weights.flatten().to_numpy().astype(float)
        self.row = np.repeat(np.arange(len(self.many)), self.many)
        self.square = np.bincount(self.row, self.w**2, len(self.many))

    def dots(self, dense: np.ndarray) -> np.ndarray:
        """Products of the rows with each of the dense vectors."""
        out = np.empty((len(self.many), len(dense)))
        for c, v in enumerate(dense):
            out[:, c] = np.bincount(self.row, self.w * v[self.at], len(self.many))
        return out

    def gaps(self, centres: np.ndarray) -> np.ndarray:
        return np.maximum(self.square[:, None] - 2 * self.dots(centres) + (centres**2).sum(1), 0)

    def dense(self, i: int, dims: int) -> np.ndarray:
        return np.bincount(self.at[self.row == i], self.w[self.row == i], dims)


@contextmanager
def _kept(df: DataFrame, places: str, weights: str) -> Iterator[DataFrame]:
    vectors = df.select(F.col(places).alias("p"), F.col(weights).alias("w")).filter("p is not null")
    held = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _sample(vectors: DataFrame) -> tuple[Rows, np.ndarray]:
    """At most ``INIT_ROWS`` distinct rows, those that a draw by hash and copies puts first, and
    how often each occurs."""
    keyed = vectors.select("p", "w", F.xxhash64("p", "w").alias("h"), F.xxhash64(F.lit(1), "w", "p").alias("h2"))
    counts = keyed.groupBy("h", "h2").agg(F.count("*").alias("n"))
    place = (F.pmod(F.xxhash64(F.lit("wait"), "h", "h2"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    first = counts.orderBy(-F.log(place) / F.col("n"), "h", "h2").limit(INIT_ROWS).collect()
    wanted = vectors.sparkSession.createDataFrame([(r.h, r.h2, r.n) for r in first], "h long, h2 long, n long")
    found = keyed.join(F.broadcast(wanted), ["h", "h2"]).groupBy("h", "h2", "n").agg(F.first(F.struct("p", "w")).alias("v")).collect()
    found.sort(key=lambda r: (r.h, r.h2))
    drawn = Rows(pa.array([r.v.p for r in found], pa.list_(pa.int32())), pa.array([r.v.w for r in found], pa.list_(pa.float64())))
    return drawn, np.array([r.n for r in found], float)


def _first_centres(sample: Rows, copies: np.ndarray, dims: int, k: int, seed: int) -> np.ndarray:
    """K-means++ on the sample, weighted by copies."""
    draw = np.random.default_rng(seed)
    chosen = [sample.dense(draw.choice(len(copies), p=copies / copies.sum()), dims)]
    gap = sample.gaps(np.array(chosen))[:, 0]
    for _ in range(k - 1):
        share = gap * copies if (gap * copies).sum() > 0 else copies
        chosen.append(sample.dense(draw.choice(len(copies), p=share / share.sum()), dims))
        gap = np.minimum(gap, sample.gaps(np.array(chosen[-1:]))[:, 0])
    return np.array(chosen)


def _arrow(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in columns.items()})


def _sums(vectors: DataFrame, runs: list[np.ndarray], dims: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each run: rows, summed squared gaps, summed squares and summed vectors of its clusters.

    One pass for all runs. A task sends one row for each place that a cluster's rows touch, and
    these are added up on Spark; the driver gets at most ``dims`` numbers a cluster.
    """
    starts = np.cumsum([0, *(len(c) for c in runs)])
    stacked = np.concatenate(runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, square = (np.zeros(len(stacked)) for _ in range(3))
        total = np.zeros((len(stacked), dims))
        for batch in batches:
            x = Rows(*batch.columns)
            gaps = x.gaps(stacked)
            for low, high in zip(starts, starts[1:]):
                own = gaps[:, low:high].argmin(1) + low
                n += np.bincount(own, minlength=len(n))
                cost += np.bincount(own, gaps[np.arange(len(own)), own], len(n))
                square += np.bincount(own, x.square, len(n))
                flat = (own[x.row] - low) * dims + x.at
                total[low:high] += np.bincount(flat, x.w, (high - low) * dims).reshape(-1, dims)
        c, at = np.nonzero(total)
        full, none = np.flatnonzero(n), np.zeros(len(c))
        yield _arrow(c=c.astype(np.int32), at=at.astype(np.int32), v=total[c, at], n=none, cost=none)
        yield _arrow(c=full.astype(np.int32), at=np.full(len(full), -1, np.int32), v=square[full], n=n[full], cost=cost[full])

    parts = vectors.mapInArrow(run, "c int, at int, v double, n double, cost double")
    added = parts.groupBy("c", "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n"), F.sum("cost").alias("cost")).toPandas()
    n, cost, square, total = np.zeros(len(stacked)), np.zeros(len(stacked)), np.zeros(len(stacked)), np.zeros((len(stacked), dims))
    own, of = added[added["at"] < 0], added[added["at"] >= 0]
    n[own["c"]], cost[own["c"]], square[own["c"]] = own["n"], own["cost"], own["v"]
    total[of["c"], of["at"]] = of["v"]
    return [(n[a:b], cost[a:b], square[a:b], total[a:b]) for a, b in zip(starts, starts[1:])]


def _fit_all(vectors: DataFrame, jobs: list[tuple[int, int]], dims: int, max_iter: int, tol: float) -> list[Centres]:
    """A fit for each ``(k, seed)``; all that have not settled move on in the same pass."""
    if vectors.isEmpty():
        raise ValueError("no texts to cluster")
    sample, copies = _sample(vectors)
    centres = [_first_centres(sample, copies, dims, k, seed) for k, seed in jobs]
    active = list(range(len(jobs)))
    for _ in range(max_iter):
        moved = []
        for j, (n, _, _, total) in zip(active, _sums(vectors, [centres[j] for j in active], dims)):
            new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[j])
            if ((new - centres[j]) ** 2).sum(1).max() > tol:
                moved.append(j)
            centres[j] = new
        active = moved
        if not active:
            break
    return [Centres(c, n.astype(int), float(cost.sum())) for c, (n, cost, _, _) in zip(centres, _sums(vectors, centres, dims))]


def _cheapest(fits: list[Centres]) -> Centres:
    return min(fits, key=lambda f: float(f"{f.cost:.9g}"))


def _silhouettes(vectors: DataFrame, runs: list[np.ndarray], dims: int) -> list[float]:
    """Mean squared-Euclidean silhouette of each clustering; -1 with fewer than two clusters."""
    stats = [(c[n > 0], n[n > 0], square[n > 0], total[n > 0]) for c, (n, _, square, total) in zip(runs, _sums(vectors, runs, dims))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, value = 0, np.zeros(len(stats))
        for batch in batches:
            x = Rows(*batch.columns)
            at = np.arange(len(x.many))
            rows += len(at)
            for r, (c, n, square, total) in enumerate(stats):
                if len(n) < 2:
                    continue
                own = x.gaps(c).argmin(1)
                far = np.maximum(x.square[:, None] * n - 2 * x.dots(total) + square, 0)
                inside = far[at, own] / np.maximum(n[own] - 1, 1)
                far /= n
                far[at, own] = np.inf
                outside = far.min(1)
                top = np.maximum(inside, outside)
                value[r] += np.where((n[own] > 1) & (top > 0), (outside - inside) / np.where(top > 0, top, 1), 0).sum()
        yield _arrow(r=np.arange(len(stats), dtype=np.int32), value=value, rows=np.full(len(stats), rows))

    parts = vectors.mapInArrow(run, "r int, value double, rows long")
    got = {r.r: r.v / r.n for r in parts.groupBy("r").agg(F.sum("value").alias("v"), F.sum("rows").alias("n")).collect()}
    return [got[r] if len(s[1]) > 1 else -1.0 for r, s in enumerate(stats)]


def best_k(
    df: DataFrame, dims: int, ks: Iterable[int] = range(3, 11), places: str = "places", weights: str = "weights", starts: int = 10,
    seed: int = 42, max_iter: int = 300, tol: float = 1e-9,
) -> BestK:
    """The fit, best of several starts, at the k with the highest silhouette; the smaller k on a tie.

    All starts of all k move together, one pass an iteration. One k is taken as it is.
    """
    ks = sorted(set(ks))
    with _kept(df, places, weights) as vectors:
        fits = _fit_all(vectors, [(k, seed + i) for k in ks for i in range(starts)], dims, max_iter, tol)
        models = {k: _cheapest(fits[i * starts : (i + 1) * starts]) for i, k in enumerate(ks)}
        scores = dict(zip(ks, _silhouettes(vectors, [models[k].centres for k in ks], dims))) if len(ks) > 1 else {ks[0]: 0.0}
    chosen = max(ks, key=lambda k: (round(scores[k], 12), -k))
    return BestK(chosen, models[chosen], scores)


def assign(model: Centres, df: DataFrame, places: str = "places", weights: str = "weights") -> DataFrame:
    """Adds the cluster of each row, null for a null vector; one pass, no shuffle."""

    @F.arrow_udf("int")
    def cluster(p: pa.Array, w: pa.Array) -> pa.Array:
        # A null row has no places here, and its nearest centre is masked.
        return pa.array(Rows(p, w).gaps(model.centres).argmin(1).astype(np.int32), mask=p.is_null().to_numpy(zero_copy_only=False))

    return df.withColumn("cluster", cluster(F.col(places), F.col(weights)))
