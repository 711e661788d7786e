"""Starts of K-means on large tables with repeated vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodlake.operators import clustering

ROWS = 100_000


def test_one_vector_is_a_third(spark):
    x = lambda salt: F.rand(salt)
    rows = spark.range(ROWS, numPartitions=8).withColumn("embedding", F.when(F.col("id") % 3 == 0, F.array(F.lit(9.0), F.lit(9.0))).otherwise(F.array(x(1), x(2))))
    vectors = rows.select(F.col("embedding").alias("v"))
    drawn, weight = clustering._sample(vectors)
    assert len(drawn) == clustering.INIT_ROWS == len({tuple(v) for v in drawn})
    hot = (drawn == 9.0).all(1)
    assert hot.sum() == 1 and weight[hot][0] == pytest.approx(ROWS / 3, rel=0.001)
    assert weight.sum() == pytest.approx(ROWS, rel=0.1)
    model = clustering.fit_kmeans(rows, 2, starts=2, max_iter=20)
    assert sorted(model.sizes) == [33_334, 66_666]
    assert np.abs(model.centres - 9).max(1).min() < 1e-9


def test_three_distinct_vectors(spark):
    rows = spark.range(ROWS, numPartitions=8).withColumn("embedding", F.array((F.col("id") % 3).cast("double"), F.lit(1.0)))
    drawn, weight = clustering._sample(rows.select(F.col("embedding").alias("v")))
    assert drawn.tolist() == [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]] and weight.tolist() == [33_334, 33_333, 33_333]
    model = clustering.fit_kmeans(rows, 3, starts=2, max_iter=20)
    assert sorted(model.sizes) == [33_333, 33_333, 33_334] and model.cost == pytest.approx(0, abs=1e-6)
