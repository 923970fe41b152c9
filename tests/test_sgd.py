"""Gradient descent against a NumPy run over the same order, and errors of windows and labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakeflow.operators import models, rules


def rows(seed, n):
    r = np.random.RandomState(seed)
    x = r.randn(n, 3) * [1, 10, 0.1] + [0, 5, -1]
    y = (x[:, 0] - x[:, 1] / 10 + r.randn(n) * 0.5 > 0).astype(int)
    return [(i, *map(float, a), int(b)) for i, (a, b) in enumerate(zip(x, y))]


def frame(spark, data):
    return spark.createDataFrame(data, "bet_id long, a double, b double, c double, label int")


def test_descent_is_that_of_numpy_in_the_same_order(spark):
    data = rows(3, 600)
    df = frame(spark, data + [(None, 1.0, 1.0, 1.0, 1), (9999, 1.0, 1.0, 1.0, None)])
    model = models.sgd_baseline(df.repartition(7), ["a", "b", "c"], shards=4, epochs=3)
    placed = frame(spark, data).select("*", F.expr("cast(pmod(xxhash64('shard', bet_id), 4) as int)").alias("s"), F.xxhash64(F.lit("order"), "bet_id").alias("o")).collect()
    x = np.array([[r.a, r.b, r.c] for r in placed])
    x = (x - x.mean(0)) / x.std(0)
    y = np.array([r.label for r in placed], float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w = np.zeros(4)
    for epoch in range(3):
        ends = []
        for s in range(4):
            mine = sorted((i for i, r in enumerate(placed) if r.s == s), key=lambda i: placed[i].o)
            v, total = w.copy(), np.zeros(4)
            for k, i in enumerate(mine):
                p = 1 / (1 + np.exp(-(v[:3] @ x[i] + v[3])))
                rate = models.STEP / (1 + models.DECAY * (epoch * len(mine) + k))
                g = weight[i] * (p - y[i])
                v = v - rate * np.append(g * x[i] + models.PENALTY * v[:3], g)
                total += v
            ends.append((total / len(mine), len(mine)))
        w = sum(e * n for e, n in ends) / len(y)
    assert np.allclose([*model.weights, model.bias], w, atol=1e-9)
    assert model.steps[0] > model.steps[-1]
    again = models.sgd_baseline(df.coalesce(1), ["a", "b", "c"], shards=4, epochs=3)
    assert np.allclose(again.weights, model.weights, atol=1e-12)
    right = frame(spark, data).select(((model.score(["a", "b", "c"]) > 0.5).cast("int") == F.col("label")).alias("r")).where("r").count()
    assert right > 0.85 * len(data)


def test_one_class_is_an_error(spark):
    for data in ([], [(1, 1.0, 1.0, 1.0, 1)]):
        with pytest.raises(ValueError):
            models.sgd_baseline(frame(spark, data), ["a"])


def test_empty_windows_and_bad_labels_are_errors(spark):
    df = frame(spark, rows(1, 20))
    assert rules.time_window(df, "bet_id", 3, 6, required=True).count() == 3 and rules.time_window(df, "bet_id", 90, 99).count() == 0
    with pytest.raises(ValueError, match="no row"):
        rules.time_window(df, "bet_id", 90, 99, required=True)
    assert rules.binary_labels(df) is df
    with pytest.raises(ValueError, match="1 of 21"):
        rules.binary_labels(df.unionByName(frame(spark, [(1, 1.0, 1.0, 1.0, None)])))
    with pytest.raises(ValueError, match="no labels"):
        rules.binary_labels(df.limit(0))
