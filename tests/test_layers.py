"""Convolution, pooling and dense layers over sequences of vectors; short inputs; rows without a score."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import layers as Ly
from tessera.operators import metrics as M


def one(spark, x, column, kind="array<array<double>>"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize("padding,stride,steps", [("valid", 1, 18), ("same", 1, 20), ("valid", 2, 9), ("same", 2, 19)])
def test_conv_channels(spark, padding, stride, steps):
    rng = np.random.default_rng(1)
    x, w, b = rng.normal(size=(20, 5)), rng.normal(size=(3, 5, 8)), rng.normal(size=8)
    got = np.array(one(spark, x.tolist(), Ly.conv1d_channels("x", w.tolist(), b.tolist(), stride, padding)))
    pad = ((20 - 1) * stride + 3 - 20) // 2 if padding == "same" else 0
    xp = np.pad(x, ((pad, pad), (0, 0)))
    want = [np.einsum("jc,jcf->f", xp[i:i + 3], w) + b for i in range(0, len(xp) - 2, stride)]
    assert got.shape == (len(want), 8) and np.allclose(got, want)
    assert got.shape[0] == steps


def test_one_channel_is_conv1d(spark):
    x, w = [[1.0], [2.0], [4.0], [8.0]], [[[0.5, 1.0]], [[-1.0, 2.0]]]
    plain = one(spark, [v[0] for v in x], Ly.conv1d("x", [k[0] for k in w], [0.1, 0.2]), "array<double>")
    assert one(spark, x, Ly.conv1d_channels("x", w, [0.1, 0.2])) == plain


def test_pool_channels_and_dense_steps(spark):
    x = np.random.default_rng(2).normal(size=(20, 8))
    top = np.array(one(spark, x.tolist(), Ly.max_pool_channels("x", 2)))
    mean = np.array(one(spark, x.tolist(), Ly.avg_pool_channels("x", 3, 2)))
    assert top.shape == (10, 8) and np.allclose(top, x.reshape(10, 2, 8).max(axis=1))
    assert np.allclose(mean, [x[i:i + 3].mean(axis=0) for i in range(0, 18, 2)])
    w, b = np.random.default_rng(3).normal(size=(8, 3)), [1.0, 2.0, 3.0]
    assert np.allclose(one(spark, x.tolist(), Ly.dense_steps("x", w.tolist(), b)), x @ w + b)


@pytest.mark.parametrize("x", [[], [5.0], [1.0, 2.0]])
def test_short_input_fails(spark, x):
    for layer in (Ly.max_pool, Ly.avg_pool):
        with pytest.raises(Exception, match="shorter than the pool"):
            one(spark, x, layer("x", 3, 2), "array<double>")
        assert one(spark, None, layer("x", 3, 2), "array<double>") is None
    assert one(spark, [1.0, 2.0, 9.0], Ly.max_pool("x", 3, 2), "array<double>") == [9.0]
    with pytest.raises(Exception, match="shorter than the kernel"):
        one(spark, [[v] for v in x], Ly.conv1d_channels("x", [[[1.0]]] * 3, [0.0]))
    with pytest.raises(Exception, match="channels"):
        one(spark, [[1.0, 2.0], [1.0]], Ly.conv1d_channels("x", [[[1.0], [1.0]]], [0.0]))


def test_rows_without_a_score_take_no_part(spark):
    rows = [(0.9, 1), (0.4, 0), (0.4, 1), (0.2, 0)]
    schema = "Probability double, Actual int"
    some = spark.createDataFrame(rows, schema)
    more = spark.createDataFrame(rows + [(None, 1), (float("nan"), 0)], schema)
    for f in (M.roc_curve, M.pr_curve, M.roc_auc, M.threshold_scan, M.binary_metrics):
        a, b = (sorted(map(tuple, f(d).collect()), key=repr) for d in (some, more))
        assert a == b, f.__name__
