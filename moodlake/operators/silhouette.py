"""The silhouette with plain distances, from summaries of the clusters, with a proven bound.

The mean distance of a row to a cluster cannot be had from sums, as the squared one can. Here every
cluster is cut into cells, kept as size, mean and variance. By Jensen's inequality the mean
distance of x to the rows of a cell with mean c and variance v lies between ``|x - c|`` and
``sqrt(|x - c|^2 + v)``. So each row's silhouette lies between two numbers, and their means hold the
true mean between them. Rows meet cells, never rows: the work is linear in the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodlake.operators.clustering import _gaps
from moodlake.session import settle

_CHUNK = 512


@dataclass(frozen=True)
class _Cells:
    """Cells by number: place of their cluster, rows, mean and variance."""

    owner: np.ndarray
    size: np.ndarray
    mean: np.ndarray
    variance: np.ndarray


def silhouette(
    df: DataFrame, cluster: str, embedding: str = "embedding", cells: int = 4096, rounds: int = 2, tolerance: float = 0.0
) -> DataFrame:
    """``(cluster, n_rows, silhouette, error)``: the true mean of a cluster is within ``error`` of ``silhouette``.

    The mean of all rows is that of ``silhouette`` weighted by ``n_rows``, as is its error. Rows with a null vector or cluster
    do not count; a row alone in its cluster, and all rows where there is one cluster, have 0; no rows
    give none. ``cells`` is shared among the clusters, of which there may be no more. With as many cells as distinct
    vectors the error is 0 but for rounding. With a ``tolerance``, a sixteenth and a quarter
    of the cells are tried first, and the first result whose mean error is within it is taken.
    The driver holds the cells: ``cells`` vectors, whatever the rows.
    """
    kind = df.schema[cluster].dataType
    known = df.select(F.col(cluster).alias("c"), F.col(embedding).cast("array<double>").alias("v")).dropna()
    rows = settle(known.withColumns({"h": F.xxhash64("v"), "h2": F.xxhash64(F.lit("second"), "v")}), "silhouette")
    names = [r.c for r in rows.select("c").distinct().limit(cells + 1).collect()]
    if len(names) > cells:
        raise ValueError(f"more than {cells} clusters")
    sizes = [cells] if tolerance <= 0 else sorted({max(cells // 16, len(names)), max(cells // 4, len(names)), cells})
    for size in sizes if names else []:
        found = _bounds(rows, names, _summaries(rows, names, max(size // len(names), 1), rounds))
        if sum(f[3] for f in found) <= tolerance * sum(f[1] for f in found):
            break
    out = [(c, n, value / n, error / n) for c, n, value, error in found] if names else []
    made = df.sparkSession.createDataFrame(out, f"{_quoted(cluster)} {kind.simpleString()}, n_rows long, silhouette double, error double")
    return made


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _summaries(rows: DataFrame, names: list, per_cluster: int, rounds: int) -> _Cells:
    """Cells around distinct vectors drawn by hash, moved ``rounds`` times to the means of their rows."""
    in_cluster = Window.partitionBy("c").orderBy(F.xxhash64(F.lit("seed"), "h", "h2"), "h", "h2")
    drawn = rows.select("c", "h", "h2").distinct().withColumn("_nth", F.row_number().over(in_cluster))
    # At most ``cells`` rows, so they may be broadcast.
    drawn = F.broadcast(drawn.filter(F.col("_nth") <= per_cluster).select("c", "h", "h2"))
    seeds = rows.join(drawn, ["c", "h", "h2"]).groupBy("c", "h", "h2").agg(F.first("v").alias("v")).collect()
    place = {c: i for i, c in enumerate(names)}
    seeds = sorted(seeds, key=lambda r: (place[r.c], r.h, r.h2))
    owner, mean = np.array([place[r.c] for r in seeds]), np.array([r.v for r in seeds])
    for _ in range(rounds + 1):
        owner, size, mean, variance = _moved(rows, place, owner, mean)
    return _Cells(owner, size, mean, variance)


def _moved(rows: DataFrame, place: dict, owner: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, size, mean and variance of the cells, each row going to the nearest centre of its cluster.

    A task sends a row for each cell that it met.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, square, total = np.zeros(len(centre)), np.zeros(len(centre)), np.zeros(centre.shape)
        for frame in frames:
            for c, part in frame.groupby("c"):
                mine = np.flatnonzero(owner == place[c])
                every = np.stack(part["v"].to_numpy())
                for x in np.array_split(every, -(-len(every) // _CHUNK)):
                    at = mine[_gaps(x, centre[mine]).argmin(1)]
                    off = x - centre[at]
                    np.add.at(n, at, 1)
                    np.add.at(square, at, (off**2).sum(1))
                    np.add.at(total, at, off)
        full = np.flatnonzero(n)
        if len(full):  # a task may have no rows
            yield pd.DataFrame({"at": full, "n": n[full].astype(int), "square": square[full], "total": list(total[full])})

    parts = rows.select("c", "v").mapInPandas(run, "at int, n long, square double, total array<double>")
    parts = parts.withColumn("total", array_to_vector("total"))
    got = parts.groupBy("at").agg(F.sum("n"), F.sum("square"), Summarizer.sum(F.col("total"))).sort("at").collect()
    at = np.array([r[0] for r in got])
    n = np.array([r[1] for r in got], float)
    # Offsets from the old centre: copies of one vector have a variance of exactly 0.
    shift = np.array([r[3].toArray() for r in got]) / n[:, None]
    variance = np.maximum(np.array([r[2] for r in got]) / n - (shift**2).sum(1), 0)
    return owner[at], n, centre[at] + shift, variance


def _bounds(rows: DataFrame, names: list, cells: _Cells) -> list[tuple]:
    """Per cluster its rows, and the sums of the middles and half widths of their silhouettes."""
    place = {c: i for i, c in enumerate(names)}
    weight = np.zeros((len(cells.owner), len(names)))
    weight[np.arange(len(cells.owner)), cells.owner] = cells.size
    size = weight.sum(0)
    # Distances are taken around the common mean, where rounding is least.
    middle = np.average(cells.mean, axis=0, weights=cells.size)
    mean = cells.mean - middle

    def ratio(inside: np.ndarray, outside: np.ndarray) -> np.ndarray:
        top = np.maximum(inside, outside)
        return np.where(top > 0, (outside - inside) / np.where(top > 0, top, 1), 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, least, most = (np.zeros(len(names)) for _ in range(3))
        for frame in frames:
            places = frame["c"].map(place).to_numpy()
            for start in range(0, len(frame), _CHUNK):
                own = places[start : start + _CHUNK]
                gaps = _gaps(np.stack(frame["v"].to_numpy()[start : start + _CHUNK]) - middle, mean)
                np.add.at(n, own, 1)
                if len(names) < 2:
                    continue
                at = np.arange(len(own))
                low, high = np.sqrt(gaps) @ weight, np.sqrt(gaps + cells.variance) @ weight
                others = np.maximum(size[own] - 1, 1)
                inside = low[at, own] / others, high[at, own] / others
                low, high = low / size, high / size
                low[at, own] = high[at, own] = np.inf
                alone = size[own] < 2
                np.add.at(least, own, np.where(alone, 0, ratio(inside[1], low.min(1))))
                np.add.at(most, own, np.where(alone, 0, ratio(inside[0], high.min(1))))
        yield pd.DataFrame({"at": range(len(names)), "n": n.astype(int), "least": least, "most": most})

    parts = rows.select("c", "v").mapInPandas(run, "at int, n long, least double, most double")
    got = parts.groupBy("at").agg(F.sum("n"), F.sum("least"), F.sum("most")).collect()
    return [(names[at], n, (least + most) / 2, (most - least) / 2) for at, n, least, most in got]
