"""Queries over losses (L1-L7), array layers and activations (L8-L12,
H8-H13), fitting (M3, M4), model reports (M2, K21, C5) and the submission
path (K22, C3, C4, G1-G3)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import scalar as H
from tessera.operators import fit as Fit
from tessera.operators import layers as Ly
from tessera.operators import losses as Lo
from tessera.operators import metrics as M
from tessera.operators import scaling as S
from tessera.operators import submission as Sub
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import BARS, PANEL_CTES, feature_sql, with_
from tessera.plans.queries_eval import P, predictions
from tessera.plans.queries_features import features_table
from tessera.sources.bars import load_bars, scoring_requests
from tessera.session import materialize
from tessera.sources.tables import read_table


def _r(c, d=12):
    return (F.round(F.col(c) if isinstance(c, str) else c, d) + F.lit(0.0)).alias(c if isinstance(c, str) else "v")


# ---- losses over the prediction table ------------------------------------------

@register("loss_mse", P + """
SELECT split, round(avg(("Probability" - "Actual") * ("Probability" - "Actual")), 9) + 0.0 AS mse FROM pred GROUP BY split""")
def q_mse(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.groupBy("split").agg(Lo.mse("Probability", F.col("Actual").cast("double")).alias("mse")).select(
        "split", _r("mse", 9))


_CLIP = "greatest(least(greatest(least(\"Probability\", 1 - 1e-8), 1e-8), 1 - 1e-8), 1e-8)"


@register("loss_bce", P + f"""
SELECT split, round(avg(-("Actual" * ln({_CLIP}) + (1 - "Actual") * ln(1 - {_CLIP}))), 9) + 0.0 AS bce
FROM pred GROUP BY split""")
def q_bce(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return p.groupBy("split").agg(Lo.bce("Probability", F.col("Actual").cast("double")).alias("bce")).select(
        "split", _r("bce", 9))


_WCLIP = "greatest(least(\"Probability\", 1 - 1e-7), 1e-7)"


@register("loss_weighted_focal", P + f"""
, cw AS (SELECT count_if("Actual" = 0) AS n0, count_if("Actual" = 1) AS n1, count(*) AS n FROM pred WHERE split = 'train'),
t AS (SELECT split, "Actual" AS y, {_WCLIP} AS p FROM pred),
u AS (SELECT split, CASE WHEN y = 0 THEN n / (2.0 * n0) * 1.2 ELSE n / (2.0 * n1) END AS w,
             pow(1 - CASE WHEN y = 1 THEN p ELSE 1 - p END, 1.0) * -(y * ln(p) + (1 - y) * ln(1 - p)) AS b FROM t, cw)
SELECT split, round(avg(w * b), 9) + 0.0 AS weighted_focal_bce FROM u GROUP BY split""")
def q_weighted(spark, sf_dir):
    p = materialize(predictions(spark, sf_dir))
    c = p.where(F.col("split") == "train").agg(F.count_if(F.col("Actual") == 0).alias("n0"),
                                              F.count_if(F.col("Actual") == 1).alias("n1"),
                                              F.count(F.lit(1)).alias("n")).first()
    w0 = c["n"] / (2.0 * c["n0"]) * 1.2
    w1 = c["n"] / (2.0 * c["n1"])
    loss = Lo.weighted_focal_bce("Probability", F.col("Actual").cast("double"), w0, w1, gamma=1.0)
    return p.groupBy("split").agg(loss.alias("weighted_focal_bce")).select("split", _r("weighted_focal_bce", 9))


# the mean is taken over all rows
_GRADS = {
    "loss_gradients": ("bce", f"""-("Actual" / {_CLIP} - (1 - "Actual") / (1 - {_CLIP}))"""),
    "loss_gradients_mse": ("mse", '2.0 * ("Probability" - "Actual")'),
    "loss_gradients_logits": ("logits", '1.0 / (1.0 + exp(-"Probability")) - "Actual"'),
}


def _gradients(kind):
    def q(spark, sf_dir):
        p = materialize(predictions(spark, sf_dir))
        g = Lo.gradients(p.withColumn("y", F.col("Actual").cast("double")), "Probability", "y",
                         "bce" if kind == "logits" else kind, from_logits=kind == "logits")
        return g.select("split", "Ticker", "Date", _r("grad", 12))
    q.__doc__ = f"L5: gradient of the mean {kind} loss, one per row."
    return q


for _name, (_kind, _expr) in _GRADS.items():
    register(_name, P + f"""
SELECT split, "Ticker", "Date", round(({_expr}) / (SELECT count(*) FROM pred), 12) + 0.0 AS grad FROM pred""")(
        _gradients(_kind))


def _emb(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


_EMB = "emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"


_SOFTMAX = """sm AS (SELECT vec_id, label, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM emb),
pr AS (SELECT vec_id, label, list_transform(e, lambda v: v / list_sum(e)) AS s FROM sm)"""


@register("loss_softmax_ce", "WITH " + _EMB + ",\n" + _SOFTMAX + """
SELECT round(sum(-ln(greatest(least(s[label + 1], 1.0), 1e-8))) / count(*), 9) + 0.0 AS softmax_ce FROM pr""")
def q_softmax_ce(spark, sf_dir):
    """L3 over the whole vectors: one class per component."""
    return _emb(spark, sf_dir).agg(Lo.softmax_ce("x", "label", 64).alias("softmax_ce")).select(_r("softmax_ce", 9))


@register("loss_softmax_ce_gradient", "WITH " + _EMB + ",\n" + _SOFTMAX + """
SELECT vec_id, list_transform(range(64), lambda i: round(
  (s[i + 1] - CASE WHEN i = label THEN 1.0 ELSE 0.0 END) / n, 12) + 0.0) AS grad
FROM pr, (SELECT count(*) AS n FROM emb)""")
def q_softmax_ce_gradient(spark, sf_dir):
    """L5 for the softmax cross-entropy: a vector per row."""
    g = Lo.gradients(_emb(spark, sf_dir), "x", "label", "softmax_ce")
    return g.select("vec_id", F.transform("grad", lambda v: F.round(v, 12) + 0.0).alias("grad"))


# ---- array layers and activations over embedding vectors ----------------------

_RNG = np.random.default_rng(20240923)
CONV_W = np.round(_RNG.normal(0, 0.5, (3, 2)), 6).tolist()   # model parameters (seeded)
CONV_B = [0.1, -0.2]
DENSE_W = np.round(_RNG.normal(0, 0.2, (64, 4)), 6).tolist()
DENSE_B = [0.0, 0.5, -0.5, 1.0]
CONV_CHANNELS = np.round(_RNG.normal(0, 0.5, (3, 4, 2)), 6).tolist()


def _conv_sql(padding: str) -> str:
    n, k, s = 64, 3, 1                        # the vectors of this table have 64 components
    pad = 1 if padding == "same" else 0       # half of k - 1 on each side
    xp = "x" if pad == 0 else f"list_concat(list_resize([]::DOUBLE[], {pad}, 0.0), x, list_resize([]::DOUBLE[], {pad}, 0.0))"
    out_len = (n + 2 * pad - k) // s + 1
    per_f = []
    for f in range(2):
        terms = " + ".join(f"xp[i * {s} + {j + 1}] * {CONV_W[j][f]!r}" for j in range(k))
        per_f.append(f"{terms} + {float(CONV_B[f])!r}")
    return (f"SELECT vec_id, list_transform(range({out_len}), lambda i: [{', '.join(per_f)}]) AS conv "
            f"FROM (SELECT vec_id, {xp} AS xp FROM emb)")


@register("layer_conv1d_valid", "WITH " + _EMB + "\n" + _conv_sql("valid"))
def q_conv_valid(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", Ly.conv1d("x", CONV_W, CONV_B, 1, "valid").alias("conv"))


@register("layer_conv1d_same", "WITH " + _EMB + "\n" + _conv_sql("same"))
def q_conv_same(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", Ly.conv1d("x", CONV_W, CONV_B, 1, "same").alias("conv"))


@register("layer_pooling", "WITH " + _EMB + """
SELECT vec_id, list_transform(range(31), lambda i: list_max(x[i * 2 + 1: i * 2 + 3])) AS max_pool,
       list_transform(range(31), lambda i: (x[i * 2 + 1] + x[i * 2 + 2] + x[i * 2 + 3]) / 3.0) AS avg_pool FROM emb""")
def q_pooling(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("vec_id", Ly.max_pool("x", 3, 2).alias("max_pool"), Ly.avg_pool("x", 3, 2).alias("avg_pool"))


@register("layer_dense", "WITH " + _EMB + "\nSELECT vec_id, [" + ", ".join(
    "0.0 + " + " + ".join(f"x[{i + 1}] * {DENSE_W[i][o]!r}" for i in range(64)) + f" + {float(DENSE_B[o])!r}"
    for o in range(4)) + "] AS dense FROM emb")
def q_dense(spark, sf_dir):
    return _emb(spark, sf_dir).select("vec_id", Ly.dense("x", DENSE_W, DENSE_B).alias("dense"))


@register("layer_embedding_lookup", """
SELECT d.doc_id, CAST(e.embedding AS DOUBLE[]) AS embedding FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id""")
def q_lookup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return Ly.embedding_lookup(docs, "doc_id", emb, "vec_id", "v")


@register("activations", "WITH " + _EMB + """
SELECT vec_id,
  list_transform(x, lambda v: round(1.0 / (1.0 + exp(-greatest(least(v * 10, 500.0), -500.0))), 9) + 0.0) AS sigmoid,
  list_transform(x, lambda v: greatest(v, 0.0)) AS relu,
  list_transform(x, lambda v: round(tanh(v * 10), 9) + 0.0) AS tanh,
  list_transform(x, lambda v: greatest(least(v, 0.2), -0.2)) AS clipped,
  list_transform(range(10), lambda i: CAST(i = label AS DOUBLE)) AS one_hot,
  CAST(list_position(x, list_max(x)) - 1 AS INTEGER) AS argmax
FROM emb""")
def q_activations(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("vec_id",
                    F.transform("x", lambda v: F.round(H.sigmoid(v * 10), 9) + 0.0).alias("sigmoid"),
                    F.transform("x", lambda v: H.relu(v)).alias("relu"),
                    F.transform("x", lambda v: F.round(H.tanh(v * 10), 9) + 0.0).alias("tanh"),
                    F.transform("x", lambda v: H.clip(v, -0.2, 0.2)).alias("clipped"),
                    H.one_hot("label", 10).alias("one_hot"), H.argmax("x").alias("argmax"))


@register("activation_softmax", "WITH " + _EMB + """,
sm AS (SELECT vec_id, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM emb)
SELECT vec_id, list_transform(e, lambda v: round(v / list_sum(e), 9) + 0.0) AS softmax FROM sm""")
def q_softmax(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select("vec_id", F.transform(H.softmax("x"), lambda v: F.round(v, 9) + 0.0).alias("softmax"))


# ---- normalisation -------------------------------------------------------------

@register("batchnorm_batches", with_(BARS) + """
SELECT "Date", feature, CAST(avg(x) AS FLOAT) AS mean, CAST(var_pop(x) AS FLOAT) AS var, count(*) AS n FROM (
  UNPIVOT (SELECT "Date", "Close", "Volume" FROM bars) ON "Close", "Volume" INTO NAME feature VALUE x)
GROUP BY ALL""")
def q_bn_batches(spark, sf_dir):
    st = Lo.batch_statistics(load_bars(spark, sf_dir), "Date", ["Close", "Volume"])
    return st.select("Date", "feature", F.col("mean").cast("float").alias("mean"),
                     F.col("var").cast("float").alias("var"), "n")


@register("batchnorm_running", with_(BARS) + """,
st AS (SELECT "Date", feature, avg(x) AS mean, var_pop(x) AS var FROM (
  UNPIVOT (SELECT "Date", "Close", "Volume" FROM bars) ON "Close", "Volume" INTO NAME feature VALUE x) GROUP BY ALL),
w AS (SELECT feature, mean, var, count(*) OVER (PARTITION BY feature) AS k,
             row_number() OVER (PARTITION BY feature ORDER BY "Date") AS i FROM st)
SELECT feature, round(pow(0.9, any_value(k)) * 0.0 + sum(0.1 * pow(0.9, k - i) * mean), 6) + 0.0 AS running_mean,
       round(pow(0.9, any_value(k)) * 1.0 + sum(0.1 * pow(0.9, k - i) * var), 2) + 0.0 AS running_var
FROM w GROUP BY feature""")
def q_bn_running(spark, sf_dir):
    st = Lo.batch_statistics(load_bars(spark, sf_dir), "Date", ["Close", "Volume"])
    r = Lo.running_statistics(st, "Date")
    return r.select("feature", _r("running_mean", 6), _r("running_var", 2))


@register("batchnorm_apply", "WITH " + _EMB + """,
s AS (SELECT [""" + ", ".join(f"avg(x[{j + 1}])" for j in range(64)) + "] AS m, [" + ", ".join(
    f"var_pop(x[{j + 1}])" for j in range(64)) + """] AS v FROM emb WHERE label = 0)
SELECT vec_id, list_transform(range(64), lambda j: round((x[j + 1] - m[j + 1]) / sqrt(v[j + 1] + 1e-5) * 1.5 + 0.25, 9) + 0.0) AS normalised
FROM emb, s""")
def q_bn_apply(spark, sf_dir):
    """L6 with statistics of the label-0 batch, over all components."""
    e = _emb(spark, sf_dir)
    means, variances = Lo.vector_statistics(e.where(F.col("label") == 0), "x")
    out = Lo.batchnorm_apply("x", means, variances, [1.5] * len(means), [0.25] * len(means))
    return e.select("vec_id", F.transform(out, lambda v: F.round(v, 9) + 0.0).alias("normalised"))


@register("batchnorm_normalise", with_(BARS) + """
SELECT "Date", "Ticker", round(("Close" - avg("Close") OVER d) / sqrt(var_pop("Close") OVER d + 1e-5), 6) + 0.0 AS "Close",
  round(("Volume" - avg("Volume") OVER d) / sqrt(var_pop("Volume") OVER d + 1e-5), 6) + 0.0 AS "Volume"
FROM bars WINDOW d AS (PARTITION BY "Date")""")
def q_bn_normalise(spark, sf_dir):
    """Every bar normalised by its own day's statistics."""
    out = Lo.batch_normalise(load_bars(spark, sf_dir).select("Date", "Ticker", "Close", "Volume"), "Date",
                             ["Close", "Volume"])
    return out.select("Date", "Ticker", _r("Close", 6), _r("Volume", 6))


# ---- fitting (M3, M4) -----------------------------------------------------------

FIT_FEATURES = ["rsi", "bb_position", "volatility_ratio_30_60", "close_to_ma_50", "return_10d"]


def _fit_table(spark, sf_dir):
    f = materialize(features_table(spark, sf_dir, FIT_FEATURES).select("split", "Ticker", "Date", "target", *FIT_FEATURES))
    stats = S.fit_scaler(f.where(F.col("split") == "train"), FIT_FEATURES)
    return S.apply_scaler(f, stats)


@register("fit_gradient_at_zero", with_(*PANEL_CTES, feature_sql()) + """,
tr AS (SELECT * FROM feat WHERE split = 'train'),
lng AS (UNPIVOT (SELECT target, """ + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FIT_FEATURES)
    + """, 1.0 AS _one FROM tr) ON COLUMNS(* EXCLUDE (target)) INTO NAME feature VALUE x)
SELECT feature, round(sum(x * (0.5 - target)) / count(*), 12) + 0.0 AS gradient FROM lng GROUP BY feature""")
def q_gradient_zero(spark, sf_dir):
    """M4: gradient of the mean log-loss at w = 0, b = 0 (unscaled features)."""
    tr = features_table(spark, sf_dir, FIT_FEATURES).where(F.col("split") == "train").select("target", *FIT_FEATURES)
    gw, gb, n, _ = Fit.logistic_gradient(tr, FIT_FEATURES, [0.0] * len(FIT_FEATURES), 0.0)
    rows = [(c, float(gw[c])) for c in FIT_FEATURES] + [("_one", float(gb))]
    df = spark.createDataFrame(rows, "feature string, gradient double")
    return df.select("feature", _r("gradient"))


@register("fit_ml_logistic")
def q_ml_logistic(spark, sf_dir):
    """M3: class-weighted, L2-regularised logistic regression, fitted on train; scores of all splits."""
    t = Fit.with_balanced_weight(_fit_table(spark, sf_dir), boost0=1.2)
    va_, model = Fit.fit_ml_logistic(t.where(F.col("split") == "train"), FIT_FEATURES)
    scored = model.transform(va_.transform(t))
    from pyspark.ml.functions import vector_to_array
    return scored.select("split", "Ticker", "Date", "target",
                         vector_to_array("probability")[1].alias("Probability"))


def _vectors(spark, sf_dir):
    """(split, target, _features) of the scaled fit table's train and val rows, written once."""
    t = _fit_table(spark, sf_dir).where(F.col("split").isin("train", "val"))
    return materialize(Fit.assembled(t, FIT_FEATURES, ["split", "target"]))


@register("fit_grid_search")
def q_grid(spark, sf_dir):
    """M6: regularisation strength and mix of a logistic regression, judged on the val split; a
    negative strength is no valid point and is reported as failed."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.tuning import ParamGridBuilder
    rows = _vectors(spark, sf_dir)
    lr = LogisticRegression(featuresCol="_features", labelCol="target", maxIter=30)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    grid.append({lr.regParam: -1.0})
    _, report = Fit.grid_search(lr, grid, rows.where("split = 'train'"), rows.where("split = 'val'"))
    return report.select("point", "params", _r("val_accuracy", 9), _r("val_loss", 9), F.col("error").isNotNull().alias("failed"),
                         "rank")


def _boosted(spark, sf_dir):
    rows = _vectors(spark, sf_dir).withColumn("is_val", F.col("split") == "val")
    return rows, Fit.boosted_trees(rows, "is_val")


@register("fit_early_stopping")
def q_early_stopping(spark, sf_dir):
    """M5: boosted trees that stop by the val split; trees kept of the limit, and the scores there."""
    rows, model = _boosted(spark, sf_dir)
    accuracy, loss = Fit.validation_scores(model, rows.where("is_val"))
    return spark.createDataFrame([(60, model.getNumTrees, accuracy, loss)],
                                 "tree_limit int, best_iteration int, val_accuracy double, val_loss double")


@register("fit_history")
def q_history(spark, sf_dir):
    """M7: loss per iteration of the logistic regression (train) and of boosted trees (train, val)."""
    from pyspark.ml.classification import LogisticRegression
    rows, model = _boosted(spark, sf_dir)
    train = rows.where("split = 'train'")
    lr = LogisticRegression(featuresCol="_features", labelCol="target", maxIter=30).fit(train)
    trees = Fit.boosting_history(model, train, rows.where("is_val"))
    return trees.withColumn("model", F.lit("trees")).unionByName(
        Fit.logistic_history(spark, lr).withColumn("model", F.lit("logistic")))


@register("layer_conv1d_channels", "WITH " + _EMB + f"""
SELECT vec_id, list_transform(range(14), lambda i: [{", ".join(
    " + ".join(f"x[i * 4 + {j * 4 + c + 1}] * {CONV_CHANNELS[j][c][f]!r}" for j in range(3) for c in range(4)) + f" + {CONV_B[f]!r}"
    for f in range(2))}]) AS conv FROM emb""")
def q_conv_channels(spark, sf_dir):
    """L8 over 16 steps of 4 channels."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.slice("x", i * 4 + 1, 4))
    return _emb(spark, sf_dir).select("vec_id", Ly.conv1d_channels(steps, CONV_CHANNELS, CONV_B).alias("conv"))


# ---- model reports (K21, C5) ---------------------------------------------------

_MODEL_SQL = with_(*PANEL_CTES, feature_sql()) + """,
sc AS (SELECT split, target AS "Actual", 'rsi' AS model, round(1.0 / (1.0 + exp(-(rsi - 50.0) / 10.0)), 4) AS p FROM feat
  UNION ALL SELECT split, target, 'bollinger', round(greatest(least(bb_position, 1.0), 0.0), 4) FROM feat
  UNION ALL SELECT split, target, 'trend', round(1.0 / (1.0 + exp(-(trend_slope_30 * 100.0))), 4) FROM feat),
acc AS (SELECT model, split, avg(CAST(CAST(p > 0.5 AS INTEGER) = "Actual" AS DOUBLE)) * 100 AS acc,
   avg(CASE WHEN "Actual" = 0 THEN CAST(p <= 0.5 AS DOUBLE) END) * 100 AS acc0,
   avg(CASE WHEN "Actual" = 1 THEN CAST(p > 0.5 AS DOUBLE) END) * 100 AS acc1,
   avg(-("Actual" * ln(greatest(least(p, 1 - 1e-8), 1e-8)) + (1 - "Actual") * ln(1 - greatest(least(p, 1 - 1e-8), 1e-8)))) AS loss
   FROM sc GROUP BY model, split)"""


def model_scores(spark, sf_dir):
    f = features_table(spark, sf_dir, ["rsi", "bb_position", "trend_slope_30"])
    rsi = H.rounded(H.sigmoid((F.col("rsi") - 50.0) / 10.0), 4)
    bb = H.rounded(H.clip("bb_position", 0.0, 1.0), 4)
    tr = H.rounded(H.sigmoid(F.col("trend_slope_30") * 100.0), 4)
    base = f.select("split", F.col("target").alias("Actual"), rsi.alias("rsi"), bb.alias("bollinger"), tr.alias("trend"))
    return base.unpivot(["split", "Actual"], ["rsi", "bollinger", "trend"], "model", "p")


@register("model_leaderboard", _MODEL_SQL + """
SELECT v.model, round(v.acc, 9) + 0.0 AS val_accuracy, round(t.acc, 9) + 0.0 AS train_accuracy,
  round(v.acc0, 9) + 0.0 AS class0_accuracy, round(v.acc1, 9) + 0.0 AS class1_accuracy,
  round(100 - abs(v.acc0 - v.acc1), 9) + 0.0 AS balance, round(t.acc - v.acc, 9) + 0.0 AS generalisation_gap
FROM acc v JOIN acc t ON v.model = t.model AND v.split = 'val' AND t.split = 'train'""")
def q_leaderboard(spark, sf_dir):
    out = M.model_leaderboard(M.model_results(model_scores(spark, sf_dir)))
    return out.select("model", *[_r(c, 9) for c in out.columns if c != "model"])


@register("model_loss_ranking", _MODEL_SQL + """
SELECT v.model, round(v.loss, 9) + 0.0 AS val_loss, round(v.acc, 9) + 0.0 AS val_accuracy,
  round(t.loss, 9) + 0.0 AS test_loss, round(t.acc, 9) + 0.0 AS test_accuracy,
  CAST(row_number() OVER (ORDER BY v.loss, v.model) AS INTEGER) AS rank
FROM acc v JOIN acc t ON v.model = t.model AND v.split = 'val' AND t.split = 'test'""")
def q_loss_ranking(spark, sf_dir):
    """K21, evaluation form: models by validation loss."""
    out = M.model_losses(M.model_results(model_scores(spark, sf_dir)))
    return out.select("model", *[_r(c, 9) for c in ("val_loss", "val_accuracy", "test_loss", "test_accuracy")], "rank")


@register("model_val_test_comparison", _MODEL_SQL + """
SELECT v.model, round(v.acc, 9) + 0.0 AS val_accuracy, round(t.acc, 9) + 0.0 AS test_accuracy,
       round(t.acc - v.acc, 9) + 0.0 AS accuracy_change
FROM acc v JOIN acc t ON v.model = t.model AND v.split = 'val' AND t.split = 'test'""")
def q_val_test(spark, sf_dir):
    """Inner join of two model-result tables on the model name with differences."""
    j = M.compare_results(M.model_results(model_scores(spark, sf_dir)))
    return j.select("model", *[_r(c, 9) for c in ("val_accuracy", "test_accuracy", "accuracy_change")])


@register("model_evaluation", P + f"""
SELECT split, round(avg(-("Actual" * ln({_CLIP}) + (1 - "Actual") * ln(1 - {_CLIP}))), 9) + 0.0 AS loss,
       round(avg(CAST("Predicted" = "Actual" AS DOUBLE)) * 100, 9) + 0.0 AS accuracy FROM pred GROUP BY split""")
def q_model_eval(spark, sf_dir):
    """M2: loss and accuracy of the scores per split."""
    p = predictions(spark, sf_dir)
    out = p.groupBy("split").agg(Lo.bce("Probability", F.col("Actual").cast("double")).alias("loss"),
                                 (F.avg((F.col("Predicted") == F.col("Actual")).cast("double")) * 100).alias("accuracy"))
    return out.select("split", _r("loss", 9), _r("accuracy", 9))


# ---- submission path (K22, C3, C4, G1-G3) --------------------------------------

_REQ = """req AS (SELECT CAST(s_suppkey AS VARCHAR) AS "ID" FROM supplier
  UNION ALL SELECT CAST(s_suppkey + 1000000 AS VARCHAR) FROM supplier WHERE s_nationkey = 0)"""


def latest_predictions(spark, sf_dir):
    """K20 on the latest test prediction of every series: Pred = score > median."""
    p = predictions(spark, sf_dir).where(F.col("split") == "test")
    latest = p.groupBy("Ticker").agg(F.max_by("Probability", "Date").alias("Probability"),
                                     F.max("Date").alias("Date"))
    return M.median_threshold_predictions(latest, "Probability")


_LATEST = """lt AS (SELECT "Ticker", arg_max("Probability", "Date") AS "Probability", max("Date") AS "Date"
  FROM pred WHERE split = 'test' GROUP BY "Ticker"),
lp AS (SELECT "Ticker", "Date", CAST("Probability" > (SELECT median("Probability") FROM lt) AS INTEGER) AS "Pred" FROM lt)"""


@register("submission", P.rstrip() + ",\n" + _REQ + ",\n" + _LATEST + """
SELECT r."ID", CAST(coalesce(lp."Pred", 0) AS INTEGER) AS "Pred" FROM req r LEFT JOIN lp ON lp."Ticker" = r."ID" """)
def q_submission(spark, sf_dir):
    req = scoring_requests(read_table(spark, sf_dir, "supplier"))
    return Sub.assemble_submission(req, latest_predictions(spark, sf_dir))


@register("submission_match_report", P.rstrip() + ",\n" + _REQ + ",\n" + _LATEST + """
SELECT count(*) AS requests, count(lp."Ticker") AS matched, count_if(lp."Ticker" IS NULL) AS unmatched
FROM req r LEFT JOIN lp ON lp."Ticker" = r."ID" """)
def q_match(spark, sf_dir):
    req = scoring_requests(read_table(spark, sf_dir, "supplier"))
    return Sub.match_report(req, latest_predictions(spark, sf_dir))


@register("requests_unknown", with_(BARS, _REQ) + """
SELECT DISTINCT "ID" FROM req WHERE "ID" NOT IN (SELECT "Ticker" FROM bars)""")
def q_unknown(spark, sf_dir):
    req = scoring_requests(read_table(spark, sf_dir, "supplier"))
    return Sub.unknown_requests(req, load_bars(spark, sf_dir))


@register("requests_common_keys", with_(BARS, _REQ) + """
SELECT "ID" FROM req INTERSECT SELECT "Ticker" FROM bars""")
def q_common(spark, sf_dir):
    req = scoring_requests(read_table(spark, sf_dir, "supplier"))
    hist = load_bars(spark, sf_dir).select(F.col("Ticker").alias("ID"))
    return Sub.common_keys(req, hist, "ID")


@register("requests_missing_keys", with_(BARS, _REQ) + """
SELECT "ID" FROM req EXCEPT SELECT "Ticker" FROM bars""")
def q_missing(spark, sf_dir):
    req = scoring_requests(read_table(spark, sf_dir, "supplier"))
    hist = load_bars(spark, sf_dir).select(F.col("Ticker").alias("ID"))
    return Sub.missing_keys(req, hist, "ID")
