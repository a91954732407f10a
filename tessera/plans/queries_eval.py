"""Queries over forecast evaluation.

Scores: ``Probability`` is the position of the close in its 50-row price range
(a feature in [0, 1] made of exact IEEE steps, so the full, unrounded doubles
compare between engines) on the labelled, split panel (``Actual`` = forward
label); a second, imbalanced source scores documents by length against their
quality label.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators.features import build_features
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import PANEL_CTES, with_
from tessera.plans.queries_panel import panel
from tessera.session import materialize
from tessera.sources.tables import read_table

_RW = 'PARTITION BY split, "Ticker" ORDER BY "Date"'
PRED_SQL = f"""pos_a AS (SELECT split, "Ticker", "Date", target, "Close",
    CASE WHEN count("Close") OVER f50 >= 50 THEN min("Close") OVER f50 END AS lo,
    CASE WHEN count("Close") OVER f50 >= 50 THEN max("Close") OVER f50 END AS hi
  FROM panel WINDOW f50 AS ({_RW} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
pos_b AS (SELECT *, CASE WHEN (hi - lo) + 1e-8 = 0 THEN NULL ELSE ("Close" - lo) / ((hi - lo) + 1e-8) END AS x FROM pos_a),
pred AS (SELECT split, "Ticker", "Date", target AS "Actual", p AS "Probability",
    CAST(p > 0.5 AS INTEGER) AS "Predicted" FROM (
  SELECT *, coalesce(last_value(x IGNORE NULLS) OVER ({_RW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value(x IGNORE NULLS) OVER ({_RW} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING),
                     0.0) AS p FROM pos_b))"""
P = with_(*PANEL_CTES, PRED_SQL)


def predictions(spark, sf_dir):
    f = build_features(panel(spark, sf_dir), only=["price_position_50"]).select("split", "Ticker", "Date", "target", "price_position_50")
    p = F.col("price_position_50")
    return f.select("split", "Ticker", "Date", F.col("target").alias("Actual"), p.alias("Probability"),
                    (p > 0.5).cast("int").alias("Predicted"))


def _zd(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


def _rates(src: str, keys: str) -> str:
    return f"""SELECT {keys}tp, fp, tn, fn, {_zd('tp + tn', 'tp + fp + tn + fn')} AS accuracy,
  {_zd('tp', 'tp + fp')} AS precision, {_zd('tp', 'tp + fn')} AS recall,
  {_zd('2 * tp', '2 * tp + fp + fn')} AS f1 FROM {src}"""


_COUNTS = """count_if("Predicted" = 1 AND "Actual" = 1) AS tp, count_if("Predicted" = 1 AND "Actual" = 0) AS fp,
  count_if("Predicted" = 0 AND "Actual" = 0) AS tn, count_if("Predicted" = 0 AND "Actual" = 1) AS fn"""


@register("eval_binary_metrics", P + _rates(f"(SELECT split, {_COUNTS} FROM pred GROUP BY split)", "split, "))
def q_binary(spark, sf_dir):
    return M.binary_metrics(predictions(spark, sf_dir), "split")


@register("eval_confusion_matrix", P + """
SELECT split, "Actual", "Predicted", count(*) AS n FROM pred GROUP BY ALL""")
def q_confusion(spark, sf_dir):
    return M.confusion_matrix(predictions(spark, sf_dir), "split")


@register("eval_class_accuracy", P + """
SELECT split, "Actual", count(*) AS support,
       avg(CAST("Predicted" = "Actual" AS DOUBLE)) * 100 AS class_accuracy FROM pred GROUP BY ALL""")
def q_class_acc(spark, sf_dir):
    return M.class_accuracy(predictions(spark, sf_dir), "split")


@register("eval_classification_report", P + f"""
, c AS (SELECT split, {_COUNTS} FROM pred GROUP BY split),
r AS (SELECT split, CAST(tp + fp + tn + fn AS DOUBLE) AS n,
        {_zd('tp', 'tp + fp')} AS p1, {_zd('tp', 'tp + fn')} AS r1,
        {_zd('tn', 'tn + fn')} AS p0, {_zd('tn', 'tn + fp')} AS r0,
        CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, {_zd('tp + tn', 'tp + fp + tn + fn')} AS acc FROM c),
f AS (SELECT *, {_zd('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_zd('2 * p0 * r0', 'p0 + r0')} AS f1_0 FROM r)
SELECT split, '0' AS label, p0 AS precision, r0 AS recall, f1_0 AS f1, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT split, '1', p1, r1, f1_1, CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT split, 'accuracy', acc, acc, acc, CAST(n AS BIGINT) FROM f
UNION ALL SELECT split, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, CAST(n AS BIGINT) FROM f
UNION ALL SELECT split, 'weighted avg', {_zd('p0 * s0 + p1 * s1', 'n')}, {_zd('r0 * s0 + r1 * s1', 'n')},
  {_zd('f1_0 * s0 + f1_1 * s1', 'n')}, CAST(n AS BIGINT) FROM f""".replace("WITH ", "WITH ", 1))
def q_report(spark, sf_dir):
    return M.classification_report(predictions(spark, sf_dir), "split")


_HIST = """hist AS (SELECT split, "Probability", count_if("Actual" = 1) AS pos, count_if("Actual" = 0) AS neg
  FROM pred GROUP BY split, "Probability")"""
_ROC = _HIST + """,
roc AS (
  SELECT split, "Probability" AS threshold,
         sum(pos) OVER (PARTITION BY split ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS tps,
         sum(neg) OVER (PARTITION BY split ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS fps,
         sum(pos) OVER (PARTITION BY split) AS "P", sum(neg) OVER (PARTITION BY split) AS "N" FROM hist
  UNION ALL SELECT split, NULL, 0, 0, sum(pos), sum(neg) FROM hist GROUP BY split),
rocr AS (SELECT split, threshold, CAST(tps AS BIGINT) AS tps, CAST(fps AS BIGINT) AS fps,
  CASE WHEN "N" = 0 THEN NULL ELSE fps / "N" END AS fpr, CASE WHEN "P" = 0 THEN NULL ELSE tps / "P" END AS tpr FROM roc)"""
PR = P.rstrip() + ",\n"


@register("eval_roc_curve", PR + _ROC + """
SELECT split, threshold, tps, fps, round(fpr, 12) + 0.0 AS fpr, round(tpr, 12) + 0.0 AS tpr FROM rocr""")
def q_roc(spark, sf_dir):
    c = M.roc_curve(predictions(spark, sf_dir), "split")
    return c.select("split", "threshold", "tps", "fps", (F.round("fpr", 12) + 0.0).alias("fpr"),
                    (F.round("tpr", 12) + 0.0).alias("tpr"))


@register("eval_roc_auc", PR + _ROC + """
SELECT split, round(sum(a), 9) + 0.0 AS auc FROM (
  SELECT split, (fpr - lag(fpr) OVER w) * (tpr + lag(tpr) OVER w) / 2 AS a FROM rocr
  WINDOW w AS (PARTITION BY split ORDER BY fps, tps)) GROUP BY split""")
def q_auc(spark, sf_dir):
    a = M.roc_auc(predictions(spark, sf_dir), "split")
    return a.select("split", (F.round("auc", 9) + 0.0).alias("auc"))


_PRC = _HIST + """,
cum AS (SELECT split, "Probability" AS threshold,
         sum(pos) OVER (PARTITION BY split ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS tps,
         sum(neg) OVER (PARTITION BY split ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS fps,
         sum(pos) OVER (PARTITION BY split) AS "P" FROM hist),
prc AS (SELECT split, threshold, CASE WHEN tps + fps = 0 THEN NULL ELSE tps / (tps + fps) END AS precision,
               CASE WHEN "P" = 0 THEN 1.0 ELSE tps / "P" END AS recall FROM cum
        UNION ALL SELECT split, NULL, 1.0, 0.0 FROM hist GROUP BY split),
prf AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM prc)"""


@register("eval_pr_curve", PR + _PRC + """
SELECT split, threshold, round(precision, 12) + 0.0 AS precision, round(recall, 12) + 0.0 AS recall,
       round(f1, 12) + 0.0 AS f1 FROM prf""")
def q_pr(spark, sf_dir):
    c = M.pr_curve(predictions(spark, sf_dir), "split")
    return c.select("split", "threshold", *[(F.round(x, 12) + 0.0).alias(x) for x in ("precision", "recall", "f1")])


_SCAN = """scan AS (SELECT split, threshold,
    count_if("Probability" >= threshold AND "Actual" = 1) AS tp, count_if("Probability" >= threshold AND "Actual" = 0) AS fp,
    count_if("Probability" < threshold AND "Actual" = 0) AS tn, count_if("Probability" < threshold AND "Actual" = 1) AS fn
  FROM pred, (SELECT CAST(round(0.1 + 0.01 * i, 2) AS DOUBLE) AS threshold FROM range(81) t(i)) th
  GROUP BY split, threshold)"""


@register("eval_threshold_scan", PR + _SCAN + "\n" + _rates("scan", "split, threshold, "))
def q_scan(spark, sf_dir):
    return M.threshold_scan(predictions(spark, sf_dir), "split")


@register("eval_best_f1_threshold", PR + _SCAN + f"""
SELECT split, arg_min(threshold, (-f1, threshold)) AS threshold, max(f1) AS f1
FROM ({_rates("scan", "split, threshold, ")}) GROUP BY split""")
def q_best_f1(spark, sf_dir):
    return M.best_f1_threshold(M.threshold_scan(predictions(spark, sf_dir), "split"), "split")


@register("eval_youden_threshold", PR + _ROC + """
SELECT split, arg_max(threshold, (tpr - fpr, threshold)) AS threshold, round(max(tpr - fpr), 12) + 0.0 AS youden_j
FROM rocr WHERE threshold IS NOT NULL GROUP BY split""")
def q_youden(spark, sf_dir):
    y = M.youden_threshold(predictions(spark, sf_dir), "split")
    return y.select("split", "threshold", (F.round("youden_j", 12) + 0.0).alias("youden_j"))


@register("eval_pr_best_threshold", PR + _PRC + """
SELECT split, coalesce(arg_max(threshold, (f1, -coalesce(threshold, 2.0))), 0.5) AS threshold,
       round(max(f1), 12) + 0.0 AS f1 FROM prf GROUP BY split""")
def q_pr_best(spark, sf_dir):
    b = M.pr_best_threshold(predictions(spark, sf_dir), "split")
    return b.select("split", "threshold", (F.round("f1", 12) + 0.0).alias("f1"))


_CAND = _ROC + ",\n" + _PRC.replace(_HIST + ",\n", "") + ",\n" + _SCAN + f""",
cand AS (SELECT 1 AS ord, 'default' AS method, 0.5::DOUBLE AS threshold
  UNION ALL SELECT 2, 'best F1', arg_min(threshold, (-f1, threshold)) FROM ({_rates("scan", "split, threshold, ")}) WHERE split = 'val'
  UNION ALL SELECT 3, 'Youden', arg_max(threshold, (tpr - fpr, threshold)) FROM rocr WHERE threshold IS NOT NULL AND split = 'val'
  UNION ALL SELECT 4, 'PR curve', coalesce(arg_max(threshold, (f1, -coalesce(threshold, 2.0))), 0.5) FROM prf WHERE split = 'val'),
at_c AS (SELECT split, ord, method, threshold,
    count_if("Probability" >= threshold AND "Actual" = 1) AS tp, count_if("Probability" >= threshold AND "Actual" = 0) AS fp,
    count_if("Probability" < threshold AND "Actual" = 0) AS tn, count_if("Probability" < threshold AND "Actual" = 1) AS fn
  FROM pred, cand GROUP BY ALL),
at_r AS ({_rates("at_c", "split, ord, method, threshold, ")})"""


@register("eval_threshold_methods", PR + _CAND + "\nSELECT * EXCLUDE (ord) FROM at_r")
def q_methods(spark, sf_dir):
    """The four methods' thresholds from the validation split, on every split."""
    pred = materialize(predictions(spark, sf_dir))
    return M.metrics_at(pred, M.threshold_candidates(pred.where(F.col("split") == "val")), "split")


@register("eval_default_vs_optimal", PR + _CAND + f""",
best AS (SELECT arg_min(threshold, (-f1, ord)) AS threshold FROM at_r WHERE split = 'val'),
both_ AS (SELECT 'default' AS side, count_if("Probability" > 0.5 AND "Actual" = 1) AS tp, count_if("Probability" > 0.5 AND "Actual" = 0) AS fp,
    count_if("Probability" <= 0.5 AND "Actual" = 0) AS tn, count_if("Probability" <= 0.5 AND "Actual" = 1) AS fn FROM pred WHERE split = 'test'
  UNION ALL SELECT 'optimal', count_if("Probability" >= threshold AND "Actual" = 1), count_if("Probability" >= threshold AND "Actual" = 0),
    count_if("Probability" < threshold AND "Actual" = 0), count_if("Probability" < threshold AND "Actual" = 1) FROM pred, best WHERE split = 'test'),
lng AS (UNPIVOT ({_rates("both_", "side, ")}) ON accuracy, precision, recall, f1 INTO NAME metric VALUE v),
wide AS (SELECT metric, max(v) FILTER (WHERE side = 'default') AS "default", max(v) FILTER (WHERE side = 'optimal') AS optimal
  FROM lng GROUP BY metric)
SELECT metric, "default", optimal, optimal - "default" AS improvement,
       CASE WHEN "default" = 0 THEN NULL ELSE (optimal - "default") * 100 / "default" END AS improvement_pct FROM wide""")
def q_default_vs_optimal(spark, sf_dir):
    """Test split at 0.5 (strict) vs the best validation method (inclusive)."""
    pred = materialize(predictions(spark, sf_dir))
    return M.default_vs_best(pred.where(F.col("split") == "val"), pred.where(F.col("split") == "test"))


@register("eval_ticker_performance", P + f"""
, c AS (SELECT split, "Ticker", {_COUNTS} FROM pred GROUP BY split, "Ticker")
SELECT split, "Ticker", tp + fp + tn + fn AS samples, {_zd('tp + tn', 'tp + fp + tn + fn')} AS accuracy,
  {_zd('tp', 'tp + fp')} AS precision, {_zd('tp', 'tp + fn')} AS recall, {_zd('2 * tp', '2 * tp + fp + fn')} AS f1 FROM c""")
def q_ticker_perf(spark, sf_dir):
    return M.per_group_performance(predictions(spark, sf_dir), "Ticker", "split")


@register("eval_ticker_best_worst", P + f"""
, c AS (SELECT split, "Ticker", {_COUNTS} FROM pred GROUP BY split, "Ticker"),
t AS (SELECT split, "Ticker", tp + fp + tn + fn AS samples, {_zd('tp + tn', 'tp + fp + tn + fn')} AS accuracy FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY accuracy DESC, "Ticker") AS b,
             row_number() OVER (PARTITION BY split ORDER BY accuracy ASC, "Ticker") AS w FROM t)
SELECT split, "Ticker", samples, accuracy, 'best' AS rank_side FROM r WHERE b <= 10
UNION ALL SELECT split, "Ticker", samples, accuracy, 'worst' FROM r WHERE w <= 10""")
def q_best_worst(spark, sf_dir):
    t = M.per_group_performance(predictions(spark, sf_dir), "Ticker", "split").select(
        "split", "Ticker", "samples", "accuracy")
    return M.top_bottom(t, "accuracy", 10, "Ticker", "split")


_PT = """pt AS (SELECT *, CAST("Actual" = "Predicted" AS INTEGER) AS "Correct", CAST(year("Date") AS INTEGER) AS "Year",
  CAST(month("Date") AS INTEGER) AS "Month", CAST(quarter("Date") AS INTEGER) AS "Quarter" FROM pred)"""


@register("eval_accuracy_by_year", PR + _PT + """
SELECT split, "Year", avg("Correct") AS "Accuracy", count(*) AS "Count" FROM pt GROUP BY split, "Year" """)
def q_by_year(spark, sf_dir):
    return M.accuracy_by(M.prediction_table(predictions(spark, sf_dir)), "Year", "split")


@register("eval_accuracy_by_month", PR + _PT + """
SELECT split, "Month", avg("Correct") AS "Accuracy", count(*) AS "Count" FROM pt GROUP BY split, "Month" """)
def q_by_month(spark, sf_dir):
    return M.accuracy_by(M.prediction_table(predictions(spark, sf_dir)), "Month", "split")


@register("eval_ticker_accuracy_summary", P + f"""
, c AS (SELECT split, "Ticker", {_COUNTS} FROM pred GROUP BY split, "Ticker"),
t AS (SELECT split, {_zd('tp + tn', 'tp + fp + tn + fn')} AS accuracy FROM c)
SELECT split, round(avg(accuracy), 12) + 0.0 AS mean, round(stddev_samp(accuracy), 12) + 0.0 AS std,
       min(accuracy) AS min, max(accuracy) AS max FROM t GROUP BY split""")
def q_ticker_summary(spark, sf_dir):
    t = M.per_group_performance(predictions(spark, sf_dir), "Ticker", "split")
    s = M.summary_of(t, "accuracy", "split", sample=True)
    return s.select("split", (F.round("mean", 12) + 0.0).alias("mean"), (F.round("std", 12) + 0.0).alias("std"),
                    "min", "max")


@register("eval_prediction_summary", P + """
SELECT split, round(avg("Probability"), 12) + 0.0 AS mean, round(stddev_pop("Probability"), 12) + 0.0 AS std,
       min("Probability") AS min, max("Probability") AS max, median("Probability") AS median
FROM pred GROUP BY split""")
def q_pred_summary(spark, sf_dir):
    s = M.summary_of(predictions(spark, sf_dir), "Probability", "split", sample=False)
    return s.select("split", (F.round("mean", 12) + 0.0).alias("mean"), (F.round("std", 12) + 0.0).alias("std"),
                    "min", "max", "median")


@register("eval_percentiles", P + """
SELECT split, UNNEST([1, 5, 10, 25, 50, 75, 90, 95, 99]) AS pct,
       round(UNNEST(quantile_cont("Probability", [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])), 12) + 0.0 AS value
FROM pred GROUP BY split""")
def q_percentiles(spark, sf_dir):
    p = M.percentiles(predictions(spark, sf_dir), "Probability", "split")
    return p.select("split", "pct", (F.round("value", 12) + 0.0).alias("value"))


@register("eval_probability_buckets", P + """
SELECT split, CASE WHEN "Probability" < 0.1 THEN '<0.1' WHEN "Probability" < 0.3 THEN '0.1-0.3'
  WHEN "Probability" < 0.5 THEN '0.3-0.5' WHEN "Probability" < 0.7 THEN '0.5-0.7'
  WHEN "Probability" < 0.9 THEN '0.7-0.9' ELSE '>=0.9' END AS bucket, count(*) AS n FROM pred GROUP BY ALL""")
def q_buckets(spark, sf_dir):
    return M.bucket_counts(predictions(spark, sf_dir), "Probability", "split")


@register("eval_positives_at_thresholds", P + """
SELECT split, t.threshold, count_if("Probability" > t.threshold) AS positives,
       count_if("Probability" > t.threshold) * 100.0 / count(*) AS pct
FROM pred, (SELECT UNNEST([0.1, 0.2, 0.3, 0.4, 0.5]::DOUBLE[]) AS threshold) t GROUP BY split, t.threshold""")
def q_positives(spark, sf_dir):
    return M.positives_at(predictions(spark, sf_dir), groups="split")


@register("eval_probability_histogram", P + """
, r AS (SELECT split, min("Probability") AS lo, max("Probability") AS hi FROM pred GROUP BY split)
SELECT p.split, p."Actual",
  CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(("Probability" - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bin,
  count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi
FROM pred p JOIN r USING (split) GROUP BY ALL""")
def q_histogram(spark, sf_dir):
    return M.equal_width_histogram(predictions(spark, sf_dir), "Probability", 50, "split", "Actual")


@register("eval_median_threshold", P + """
, m AS (SELECT split, median("Probability") AS median_threshold FROM pred GROUP BY split)
SELECT p.split, p."Ticker", p."Date", p."Probability", m.median_threshold,
       CAST(p."Probability" > m.median_threshold AS INTEGER) AS "Pred" FROM pred p JOIN m USING (split)""")
def q_median(spark, sf_dir):
    out = M.median_threshold_predictions(predictions(spark, sf_dir), "Probability", "split")
    return out.select("split", "Ticker", "Date", "Probability", "median_threshold", "Pred")


# ---- second, imbalanced source: document quality scored by length -----------

DOC_SQL = """WITH pred AS (SELECT d.doc_id, l.quality AS "Actual",
    d.n_chars / (d.n_chars + 2000.0::DOUBLE) AS "Probability",
    CAST(d.n_chars / (d.n_chars + 2000.0::DOUBLE) > 0.5 AS INTEGER) AS "Predicted"
  FROM labels l JOIN documents d USING (doc_id))
"""


def doc_predictions(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    doc = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    p = F.col("n_chars") / (F.col("n_chars") + F.lit(2000.0))
    return lab.join(doc, "doc_id").select("doc_id", F.col("quality").alias("Actual"), p.alias("Probability"),
                                           (p > 0.5).cast("int").alias("Predicted"))


@register("eval_documents_metrics", DOC_SQL + _rates(f"(SELECT {_COUNTS} FROM pred)", ""))
def q_doc_metrics(spark, sf_dir):
    return M.binary_metrics(doc_predictions(spark, sf_dir))


@register("eval_documents_auc", DOC_SQL.rstrip() + """,
hist AS (SELECT "Probability", count_if("Actual" = 1) AS pos, count_if("Actual" = 0) AS neg FROM pred GROUP BY 1),
roc AS (SELECT sum(pos) OVER (ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS tps,
               sum(neg) OVER (ORDER BY "Probability" DESC ROWS UNBOUNDED PRECEDING) AS fps,
               sum(pos) OVER () AS "P", sum(neg) OVER () AS "N" FROM hist
        UNION ALL SELECT 0, 0, sum(pos), sum(neg) FROM hist),
r AS (SELECT tps, fps, fps / "N" AS fpr, tps / "P" AS tpr FROM roc)
SELECT round(sum(a), 9) + 0.0 AS auc FROM (
  SELECT (fpr - lag(fpr) OVER (ORDER BY fps, tps)) * (tpr + lag(tpr) OVER (ORDER BY fps, tps)) / 2 AS a FROM r)""")
def q_doc_auc(spark, sf_dir):
    a = M.roc_auc(doc_predictions(spark, sf_dir))
    return a.select((F.round("auc", 9) + 0.0).alias("auc"))


@register("eval_ticker_accuracy_histogram", P + f"""
, c AS (SELECT split, "Ticker", {_COUNTS} FROM pred GROUP BY split, "Ticker"),
t AS (SELECT split, {_zd('tp + tn', 'tp + fp + tn + fn')} AS accuracy FROM c),
r AS (SELECT split, min(accuracy) AS lo, max(accuracy) AS hi FROM t GROUP BY split)
SELECT t.split, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((accuracy - lo) / ((hi - lo) / 30)), 29) END AS INTEGER) AS bin,
       count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi FROM t JOIN r USING (split) GROUP BY ALL""")
def q_ticker_acc_hist(spark, sf_dir):
    """D13, second form: 30 equal-width bins of per-series accuracy."""
    t = M.per_group_performance(predictions(spark, sf_dir), "Ticker", "split")
    return M.equal_width_histogram(t, "accuracy", 30, "split")
