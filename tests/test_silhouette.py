"""The silhouette with plain distances against all pairs."""

import numpy as np
import pytest

from moodlake.operators.silhouette import silhouette


def brute(x, labels):
    """Mean silhouette and rows of each cluster, from all pairs."""
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = {}
    for i, own in enumerate(labels):
        same = labels == own
        others = [gap[i, labels == c].mean() for c in set(labels.tolist()) - {own}]
        value = 0.0
        if same.sum() > 1 and others:
            a, b = gap[i, same].sum() / (same.sum() - 1), min(others)
            value = (b - a) / max(a, b) if max(a, b) > 0 else 0.0
        out.setdefault(own, []).append(value)
    return {c: (len(v), sum(v) / len(v)) for c, v in out.items()}


def blobs(spark, n=300, clusters=4, dims=6, spread=1.0, seed=3):
    draw = np.random.default_rng(seed)
    labels = draw.integers(0, clusters, n)
    x = draw.normal(size=(clusters, dims))[labels] * 3 + draw.normal(size=(n, dims)) * spread
    frame = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(labels, x)], "label long, embedding array<double>")
    return frame, x, labels


def test_enough_cells_give_the_exact_value(spark):
    frame, x, labels = blobs(spark)
    want = brute(x, labels)
    got = {r.label: r for r in silhouette(frame, "label").collect()}
    assert got.keys() == want.keys()
    for c, (n, value) in want.items():
        assert got[c].n_rows == n and got[c].silhouette == pytest.approx(value, abs=1e-7) and got[c].error < 1e-6


@pytest.mark.parametrize("cells", [4, 16, 64])
def test_the_exact_value_is_within_the_error(spark, cells):
    frame, x, labels = blobs(spark)
    want = brute(x, labels)
    got = silhouette(frame, "label", cells=cells).collect()
    assert all(abs(r.silhouette - want[r.label][1]) <= r.error + 1e-9 and r.error < 1 for r in got)


def test_more_cells_give_less_error_and_a_tolerance_stops_early(spark):
    frame, x, labels = blobs(spark, clusters=3, spread=0.2)
    coarse, fine = (max(r.error for r in silhouette(frame, "label", cells=n).collect()) for n in (3, 96))
    assert fine < coarse
    loose = silhouette(frame, "label", cells=96, tolerance=0.5).collect()
    assert max(r.error for r in loose) > fine
    tight = silhouette(frame, "label", cells=400, tolerance=1e-6).collect()
    assert max(r.error for r in tight) < 1e-6


def test_copies_singles_nulls_and_clashing_names(spark):
    rows = [(0, [0.0, 0.0])] * 200 + [(0, [0.0, 2.0]), (1, [5.0, 0.0]), (2, [9.0, 0.0]), (2, [9.0, 1.0]), (None, [1.0, 1.0]), (1, None)]
    frame = spark.createDataFrame([(c, v, 1, 1) for c, v in rows], "c long, v array<double>, h long, n_rows long")
    kept = [(c, v) for c, v in rows if c is not None and v is not None]
    want = brute(np.array([v for _, v in kept]), np.array([c for c, _ in kept]))
    got = {r.c: r for r in silhouette(frame, "c", "v").collect()}
    assert {c: r.n_rows for c, r in got.items()} == {0: 201, 1: 1, 2: 2}
    assert all(got[c].silhouette == pytest.approx(v, abs=1e-7) for c, (_, v) in want.items()) and got[1].silhouette == 0


def test_one_cluster_no_rows_and_too_many_clusters(spark):
    one = spark.createDataFrame([("a", [1.0]), ("a", [2.0])], "label string, embedding array<float>")
    assert [(r.label, r.n_rows, r.silhouette, r.error) for r in silhouette(one, "label").collect()] == [("a", 2, 0.0, 0.0)]
    assert silhouette(one.limit(0), "label").count() == 0
    many = spark.range(5).selectExpr("id AS label", "array(double(id)) AS embedding")
    with pytest.raises(ValueError):
        silhouette(many, "label", cells=4)
