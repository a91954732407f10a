"""Saved models, grid search, early stopping, histories (M3-M7, A7, A8) and their brute-force forms."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import fit as Fit
from tessera.operators import losses as Lo


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1200, 2)) * [3.0, 0.2] + [10.0, -1.0]
    z = 0.4 * (x[:, 0] - 10) - 2.0 * (x[:, 1] + 1) + 0.3
    y = (rng.random(1200) < 1 / (1 + np.exp(-z))).astype(int)
    data = [("train" if i < 900 else "val", int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(data, "split string, target int, a double, b double").cache(), x, y


def newton(x, y, reg, steps=50):
    """Exact L2-regularised logistic fit (mean loss + reg/2 |w|^2 on columns of sample deviation 1)."""
    x = np.column_stack([x, np.ones(len(x))])
    scale = np.append(x[:, :-1].std(axis=0, ddof=1), 0.0)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (p - y) / len(y) + reg * scale ** 2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + reg * np.diag(scale ** 2)
        w = w - np.linalg.solve(h, g)
    return w


def test_pipeline_is_an_exact_fit_and_survives_saving(spark, rows, tmp_path):
    df, x, y = rows
    train = df.where("split = 'train'")
    model = Fit.scaling_pipeline(train, ["a", "b"], reg=0.01)
    mean, scale = x[:900].mean(axis=0), x[:900].std(axis=0)              # population
    w = newton((x[:900] - mean) / scale, y[:900], 0.01)
    assert np.allclose([*model.stages[-1].coefficients, model.stages[-1].intercept], w, atol=1e-5)
    Fit.save_model(model, str(tmp_path / "model"))
    loaded = Fit.load_model(str(tmp_path / "model"))
    before = Fit.probabilities(model, df).collect()
    after = Fit.probabilities(loaded, df).collect()
    assert before == after
    want = 1 / (1 + np.exp(-(((x - mean) / scale) @ w[:2] + w[2])))
    assert np.allclose([r.Probability for r in after], want, atol=1e-5)


def test_grid_equals_single_fits(spark, rows):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import ParamGridBuilder
    df, x, y = rows
    vec = Fit.assembled(df, ["a", "b"], ["split", "target"])
    train, val = vec.where("split = 'train'"), vec.where("split = 'val'")
    lr = LogisticRegression(featuresCol="_features", labelCol="target")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.5, 0.0]).build()
    grid.insert(1, {lr.regParam: -1.0})
    best, report = Fit.grid_search(lr, grid, train, val, parallelism=2)
    got = {r.point: r for r in report.collect()}
    assert got[1].error and got[1].rank is None and got[1].val_accuracy is None
    for i, reg in ((0, 0.0), (2, 0.5), (3, 0.0)):
        w = newton(x[:900], y[:900], reg)
        z = x[900:] @ w[:2] + w[2]
        assert got[i].val_accuracy == pytest.approx(100 * ((z > 0) == y[900:]).mean(), abs=1e-6)
        loss = np.mean(np.log1p(np.exp(-z * (2 * y[900:] - 1))))
        assert got[i].val_loss == pytest.approx(loss, abs=1e-4)
    assert got[0].val_accuracy == got[3].val_accuracy and got[0].rank < got[3].rank       # the first of equals
    first = min((r for r in got.values() if r.rank), key=lambda r: r.rank)
    assert Fit.validation_scores(best, val)[0] == first.val_accuracy
    with pytest.raises(RuntimeError, match="no point"):
        Fit.grid_search(lr, [{lr.regParam: -1.0}], train, val)


def test_trees_stop_early_and_history_ends_at_the_model_loss(spark, rows):
    df, x, y = rows
    vec = Fit.assembled(df, ["a", "b"], ["split", "target"]).withColumn("is_val", F.col("split") == "val")
    model = Fit.boosted_trees(vec, "is_val", trees=40, tolerance=0.01)
    assert 1 <= model.getNumTrees < 40
    train, val = vec.where("split = 'train'"), vec.where("is_val")
    history = Fit.boosting_history(model, train, val).collect()
    assert len(history) == 2 * model.getNumTrees
    for split, part in (("train", train), ("val", val)):
        last = max((r for r in history if r.split == split), key=lambda r: r.iteration)
        assert last.iteration == model.getNumTrees
        assert last.loss == pytest.approx(Fit.validation_scores(model, part)[1], abs=1e-6)
    falls = [r.loss for r in sorted(history, key=lambda r: r.iteration) if r.split == "train"]
    assert all(a >= b - 1e-9 for a, b in zip(falls, falls[1:]))


def test_logistic_history_ends_at_the_loss(spark, rows):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    df, _, _ = rows
    train = Fit.assembled(df, ["a", "b"], ["split", "target"]).where("split = 'train'")
    model = LogisticRegression(featuresCol="_features", labelCol="target").fit(train)
    history = Fit.logistic_history(spark, model).collect()
    scored = model.transform(train).select(vector_to_array("probability")[1].alias("p"), F.col("target").cast("double").alias("y"))
    assert history[-1].loss == pytest.approx(scored.agg(Lo.bce("p", F.col("y"))).first()[0], abs=1e-6)
    assert history[0].loss == pytest.approx(-sum(q * math.log(q) for q in [scored.agg(F.avg("y")).first()[0]] for q in (q, 1 - q)), abs=1e-9)
