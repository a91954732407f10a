"""Selection, scaling, losses, layers and fitting against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalar as H
from tessera.operators import fit as Fit
from tessera.operators import layers as Ly
from tessera.operators import losses as Lo
from tessera.operators import scaling as S
from tessera.operators import selection as Sel


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    x = np.column_stack([y + rng.normal(0, .5, 500), rng.normal(size=500), np.full(500, 3.0)])
    rows = [(int(c), *map(float, r)) for c, r in zip(y, x)]
    return spark.createDataFrame(rows, "target int, a double, b double, c double"), y, x


def test_mutual_information(table):
    df, y, x = table
    got = {r["feature"]: r["mutual_info"] for r in Sel.binned_mutual_information(df, ["a", "b", "c"]).collect()}
    for j, name in enumerate("abc"):
        lo, hi = x[:, j].min(), x[:, j].max()
        b = np.minimum(np.floor((x[:, j] - lo) / ((hi - lo) / 20)), 19) if hi > lo else np.zeros(500)
        want = 0.0
        for k in set(b.tolist()):
            for c in (0, 1):
                n = ((b == k) & (y == c)).sum()
                if n:
                    want += n / 500 * math.log(n * 500 / ((b == k).sum() * (y == c).sum()))
        assert got[name] == pytest.approx(want, abs=1e-9)


def test_scaler_and_cell_statistics(table):
    df, _, x = table
    fit = S.fit_scaler(df, ["a", "b", "c"])
    assert fit["a"] == pytest.approx((x[:, 0].mean(), x[:, 0].std())) and fit["c"] == (3.0, 1.0)
    st = S.cell_stats(df, ["a", "b", "c"]).first()
    assert tuple(st) == pytest.approx((x.min(), x.max(), x.mean()))


def test_losses_and_gradients(spark):
    y, p = np.array([0, 1, 1, 0]), np.array([0.2, 0.7, 1.0, 0.0])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "i int, y double, p double")
    assert df.agg(Lo.mse("p", "y")).first()[0] == pytest.approx(((p - y) ** 2).mean())
    c = np.clip(p, 1e-8, 1 - 1e-8)
    assert df.agg(Lo.bce("p", "y")).first()[0] == pytest.approx(-(y * np.log(c) + (1 - y) * np.log(1 - c)).mean())
    sig = 1 / (1 + np.exp(-p))
    for kind, logits, want in (("mse", False, 2 * (p - y) / 4), ("bce", True, (sig - y) / 4),
                               ("bce", False, -(y / c - (1 - y) / (1 - c)) / 4)):
        got = Lo.gradients(df, "p", "y", kind, from_logits=logits).orderBy("i").toPandas()["grad"]
        assert np.allclose(got, want)
    z = np.random.default_rng(0).normal(size=(6, 5))
    label = [0, 4, 2, 2, 1, 3]
    logits = spark.createDataFrame([(i, v.tolist(), k) for i, (v, k) in enumerate(zip(z, label))], "i int, z array<double>, k int")
    soft = np.exp(z) / np.exp(z).sum(1, keepdims=True)
    assert logits.agg(Lo.softmax_ce("z", "k", 5)).first()[0] == pytest.approx(-np.log(soft[range(6), label]).mean())
    got = np.array(Lo.gradients(logits, "z", "k", "softmax_ce").orderBy("i").toPandas()["grad"].tolist())
    assert got.shape == z.shape and np.allclose(got, (soft - np.eye(5)[label]) / 6)
    with pytest.raises(Exception, match="one-hot"):
        logits.select(H.one_hot("k", 3)).collect()


def test_batch_normalisation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(3, 2, 60)
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(x)], "b int, x double")
    got = Lo.batch_normalise(df, "b", ["x"]).groupBy("b").agg(F.avg("x").alias("m"), F.var_pop("x").alias("v")).collect()
    assert all(abs(r["m"]) < 1e-9 and abs(r["v"] - 1) < 1e-4 for r in got)
    vec = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],)], "x array<double>")
    assert Lo.vector_statistics(vec, "x") == ([2.0, 4.0], [1.0, 4.0])


@pytest.mark.parametrize("n,padding,length", [(20, "valid", 18), (20, "same", 20), (8, "valid", 6), (3, "valid", 1)])
def test_conv_takes_any_length(spark, n, padding, length):
    x = np.random.default_rng(n).normal(size=n)
    w, b = np.array([[.1, -1], [.2, 2], [.3, .5]]), [0.5, -0.5]
    got = spark.createDataFrame([(x.tolist(),)], "x array<double>").select(
        Ly.conv1d("x", w.tolist(), b, 1, padding)).first()[0]
    xp = np.pad(x, 1) if padding == "same" else x
    want = [[(xp[i:i + 3] * w[:, f]).sum() + b[f] for f in range(2)] for i in range(length)]
    assert np.allclose(got, want)


def test_layers_fail_on_a_mismatch(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    with pytest.raises(Exception, match="shorter than the kernel"):
        df.select(Ly.conv1d("x", [[1.0]] * 3, [0.0])).collect()
    with pytest.raises(Exception, match="dense layer takes 3"):
        df.select(Ly.dense("x", [[1.0], [1.0], [1.0]], [0.0])).collect()
    assert df.select(Ly.dense("x", [[1.0], [10.0]], [0.5])).first()[0] == [21.5]
    assert df.select(Ly.max_pool("x", 2), Ly.avg_pool("x", 2)).first() == ([2.0], [1.5])


def test_logistic_gradient_and_fit(table):
    df, y, x = table
    w, b = [0.3, -0.2], 0.1
    g, gb, n, loss = Fit.logistic_gradient(df, ["a", "b"], w, b)
    p = 1 / (1 + np.exp(-(x[:, :2] @ np.array(w) + b)))
    assert n == 500 and gb == pytest.approx((p - y).mean())
    assert [g["a"], g["b"]] == pytest.approx(((p - y)[:, None] * x[:, :2]).mean(0).tolist())
    assert loss == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
    weighted = Fit.with_balanced_weight(df, boost0=1.2)
    got = {r["target"]: r["w"] for r in weighted.groupBy("target").agg(F.max("weight").alias("w")).collect()}
    assert got[1] == pytest.approx(500 / (2 * (y == 1).sum())) and got[0] == pytest.approx(1.2 * 500 / (2 * (y == 0).sum()))
    va, model = Fit.fit_ml_logistic(weighted, ["a", "b"])
    scored = model.transform(va.transform(weighted)).agg(F.avg((F.col("prediction") == F.col("target")).cast("double")))
    assert scored.first()[0] > 0.8


def test_logistic_scores_all_splits(spark):
    from conftest import SF
    from tessera.plans import queries_model as Q
    got = {r["split"]: r["count"] for r in Q.q_ml_logistic(spark, SF).groupBy("split").count().collect()}
    want = {r["split"]: r["count"] for r in Q._fit_table(spark, SF).groupBy("split").count().collect()}
    assert got == want and got["train"] > 0
