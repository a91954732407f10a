import numpy as np
from pyspark.sql import functions as F

from tessera.operators import metrics as M


def _pred(spark, y, p, group="g"):
    rows = [(group, int(a), float(b)) for a, b in zip(y, p)]
    return spark.createDataFrame(rows, "split string, Actual int, Probability double").withColumn(
        "Predicted", (F.col("Probability") > 0.5).cast("int"))


def _auc_brute(y, p):
    pos = [b for a, b in zip(y, p) if a == 1]
    neg = [b for a, b in zip(y, p) if a == 0]
    s = sum(1.0 if x > z else 0.5 if x == z else 0.0 for x in pos for z in neg)
    return s / (len(pos) * len(neg))


def test_auc_matches_pairwise_with_ties(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 1)  # many ties
    got = M.roc_auc(_pred(spark, y, p), "split").first()["auc"]
    assert abs(got - _auc_brute(y, p)) < 1e-12


def test_auc_single_class_and_all_tied(spark):
    assert M.roc_auc(_pred(spark, [1, 1, 1], [0.2, 0.4, 0.9]), "split").first()["auc"] is None
    assert abs(M.roc_auc(_pred(spark, [0, 1, 0, 1], [0.5] * 4), "split").first()["auc"] - 0.5) < 1e-12


def test_threshold_scan_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    p = np.round(rng.random(500), 2)
    scan = M.threshold_scan(_pred(spark, y, p), "split").orderBy("threshold").toPandas()
    assert len(scan) == 81
    for _, r in scan.iterrows():
        pr = (p >= r["threshold"]).astype(int)
        tp = int(((pr == 1) & (y == 1)).sum())
        fp = int(((pr == 1) & (y == 0)).sum())
        assert (r["tp"], r["fp"]) == (tp, fp)


def test_classification_report_rows(spark):
    df = _pred(spark, [1, 0, 1, 1, 0], [0.9, 0.6, 0.4, 0.8, 0.1])
    rep = {r["label"]: r for r in M.classification_report(df, "split").collect()}
    assert set(rep) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert abs(rep["1"]["precision"] - 2 / 3) < 1e-12 and abs(rep["1"]["recall"] - 2 / 3) < 1e-12
    assert abs(rep["accuracy"]["precision"] - 0.6) < 1e-12


def test_zero_division_is_zero(spark):
    df = _pred(spark, [0, 0, 1], [0.1, 0.2, 0.3])
    r = M.binary_metrics(df, "split").first()
    assert r["precision"] == 0.0 and r["f1"] == 0.0


def test_pr_curve_is_whole(spark):
    df = _pred(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1])
    c = M.pr_curve(df, "split").toPandas()
    end = c[c.threshold.isna()].iloc[0]
    assert end["precision"] == 1.0 and end["recall"] == 0.0
    body = c.dropna(subset=["threshold"]).sort_values("threshold", ascending=False)
    assert body["threshold"].tolist() == [0.9, 0.8, 0.7, 0.1]       # also below the first full recall
    assert np.allclose(body["precision"], [1, 1 / 2, 2 / 3, 2 / 4]) and np.allclose(body["recall"], [.5, .5, 1, 1])
    none = M.pr_curve(_pred(spark, [0, 0], [0.3, 0.6]), "split").toPandas().dropna(subset=["threshold"])
    assert (none["recall"] == 1.0).all() and (none["precision"] == 0.0).all()


def test_curves_on_unrounded_scores_with_ties(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 800)
    p = np.where(rng.random(800) < .4, 1 / 3, rng.random(800))
    df = _pred(spark, y, p)
    assert abs(M.roc_auc(df, "split").first()["auc"] - _auc_brute(y, p)) < 1e-12
    assert abs(M.roc_auc(df).first()["auc"] - _auc_brute(y, p)) < 1e-12
    roc = M.roc_curve(df, "split").toPandas()
    assert len(roc) == len(set(p)) + 1
    at = roc[roc.threshold == 1 / 3].iloc[0]
    assert at["tps"] == ((p >= 1 / 3) & (y == 1)).sum() and at["fps"] == ((p >= 1 / 3) & (y == 0)).sum()
    q = {r["pct"]: r["value"] for r in M.percentiles(df, "Probability", "split").collect()}
    assert all(np.isclose(q[k], np.percentile(p, k)) for k in M.PERCENTILES)
    s = M.summary_of(df, "Probability", "split", sample=False).first()
    assert np.isclose(s["median"], np.median(p)) and np.isclose(s["std"], p.std())


def test_best_and_worst_lists_are_both_whole(spark):
    df = spark.createDataFrame([("g", f"t{i}", i / 10) for i in range(5)], "split string, Ticker string, accuracy double")
    got = {(r["rank_side"], r["Ticker"]) for r in M.top_bottom(df, "accuracy", 3, "Ticker", "split").collect()}
    assert got == {("best", "t4"), ("best", "t3"), ("best", "t2"), ("worst", "t0"), ("worst", "t1"), ("worst", "t2")}


def test_default_vs_best_takes_the_first_of_equal_methods(spark):
    val = _pred(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    assert M.threshold_candidates(val)["default"] == 0.5
    out = {r["metric"]: r for r in M.default_vs_best(val, val).collect()}
    assert set(out) == {"accuracy", "precision", "recall", "f1"}
    assert all(r["default"] == 1.0 and r["optimal"] == 1.0 and r["improvement"] == 0.0 for r in out.values())


def test_global_median_threshold_and_histogram(spark):
    df = _pred(spark, [0, 1, 0, 1, 1], [0.1, 0.2, 0.35, 0.45, 0.9])
    out = M.median_threshold_predictions(df).orderBy("Probability").collect()
    assert [r["Pred"] for r in out] == [0, 0, 0, 1, 1] and out[0]["median_threshold"] == 0.35
    # bins of width 0.2 from 0.1; the maximum goes to the last (closed) bin
    h = {r["bin"]: r["n"] for r in M.equal_width_histogram(df, "Probability", 4).collect()}
    assert h == {0: 2, 1: 2, 3: 1}
