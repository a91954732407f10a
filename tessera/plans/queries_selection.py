"""Queries over feature selection (K1-K3) and scaling (K4, D15) on the train split."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.scalar import rounded
from tessera.operators import scaling as S
from tessera.operators import selection as Sel
from tessera.operators.features import build_features, feature_cells, feature_names
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import PANEL_CTES, feature_sql, with_
from tessera.plans.queries_panel import panel

FEATS = feature_names()
_BASE = with_(*PANEL_CTES, feature_sql()).rstrip() + ",\n"
_TRAIN = "tr AS (SELECT * FROM feat WHERE split = 'train')"
_LONG = ("lng AS (UNPIVOT (SELECT target, " + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATS)
         + " FROM tr) ON COLUMNS(* EXCLUDE (target)) INTO NAME feature VALUE x)")
_MI = f"""{_TRAIN}, {_LONG},
rng AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM lng GROUP BY feature),
bn AS (SELECT l.feature, target AS y, CASE WHEN hi = lo THEN 0
          ELSE CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS INTEGER) END AS bin
       FROM lng l JOIN rng USING (feature)),
cnt AS (SELECT feature, bin, y, CAST(count(*) AS DOUBLE) AS n FROM bn GROUP BY ALL),
trm AS (SELECT feature, n / sum(n) OVER (PARTITION BY feature)
          * ln(n * sum(n) OVER (PARTITION BY feature)
               / (sum(n) OVER (PARTITION BY feature, bin) * sum(n) OVER (PARTITION BY feature, y))) AS t FROM cnt),
mi AS (SELECT feature, round(sum(t), 12) + 0.0 AS mutual_info FROM trm GROUP BY feature)"""


def _train_features(spark, sf_dir):
    """Not written: the 132 features of a row take many times the room of its bar, and every pass
    computes them again from the labelled panel, which is written once."""
    return feature_cells(panel(spark, sf_dir).where(F.col("split") == "train"), assume_clean=True)


@register("select_mutual_information", _BASE + _MI + "\nSELECT * FROM mi")
def q_mi(spark, sf_dir):
    return Sel.binned_mutual_information(_train_features(spark, sf_dir), FEATS)


@register("select_mutual_information_knn")
def q_mi_knn(spark, sf_dir):
    """K1 by nearest neighbours; no SQL (brute force in the tests): 132 rankings are too slow there."""
    train = panel(spark, sf_dir).where(F.col("split") == "train")
    some = lambda share: train.where(F.pmod(F.xxhash64("Ticker"), F.lit(100_000)) < F.lit(share * 100_000))
    return Sel.knn_mutual_information(feature_cells(train, assume_clean=True), FEATS, labels=train,
                                      sample=lambda share: feature_cells(some(share), assume_clean=True))


_PAIRS_COLS = [(i, j) for i in range(len(FEATS)) for j in range(i + 1, len(FEATS))]
_PAIRS_BODY = ("cw AS (SELECT " + ", ".join(
    f'corr("{FEATS[i]}", "{FEATS[j]}") AS c{i}_{j}' for i, j in _PAIRS_COLS) + " FROM tr),\n"
    + "pl AS (SELECT UNNEST([" + ", ".join(
        f"{{'feature1': '{FEATS[i]}', 'feature2': '{FEATS[j]}', 'i': {i}, 'j': {j}, 'correlation': abs(c{i}_{j})}}"
        for i, j in _PAIRS_COLS) + "], recursive := true) FROM cw),\n"
    + "pairs AS (SELECT * FROM pl WHERE correlation IS NOT NULL AND NOT isnan(correlation) AND correlation > 0.95)")
_PAIRS = f"{_TRAIN},\n{_PAIRS_BODY}"


@register("select_correlated_pairs", _BASE + _PAIRS + """
SELECT feature1, feature2, i, j, round(correlation, 9) + 0.0 AS correlation FROM pairs""")
def q_pairs(spark, sf_dir):
    p = Sel.correlated_pairs(_train_features(spark, sf_dir), FEATS)
    return p.select("feature1", "feature2", "i", "j", (F.round("correlation", 9) + 0.0).alias("correlation"))


_POS = "pos AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATS)) + ") t(feature, list_pos))"


@register("select_features", _BASE + _MI + ",\n" + _PAIRS_BODY + ",\n" + _POS + """,
ranked AS (SELECT mi.*, row_number() OVER (ORDER BY mutual_info DESC, list_pos) AS rank FROM mi JOIN pos USING (feature)),
removed AS (SELECT feature FROM ranked WHERE mutual_info < 0.001
  UNION SELECT CASE WHEN m1 < m2 THEN feature1 ELSE feature2 END FROM pairs
  JOIN (SELECT feature AS feature1, mutual_info AS m1 FROM ranked) USING (feature1)
  JOIN (SELECT feature AS feature2, mutual_info AS m2 FROM ranked) USING (feature2)),
topk AS (SELECT * FROM ranked WHERE rank <= 85),
both_ AS (SELECT feature, mutual_info, rank, CASE WHEN feature IN (SELECT feature FROM removed) THEN 1 ELSE 0 END AS src FROM topk),
sel AS (SELECT * FROM (SELECT *, count_if(src = 0) OVER () AS k, row_number() OVER (PARTITION BY src ORDER BY rank) AS e FROM both_)
        WHERE src = 0 OR e <= greatest(70 - k, 0)),
sel2 AS (SELECT feature, mutual_info, rank, row_number() OVER (ORDER BY src, rank) AS position FROM sel
  UNION ALL SELECT feature, mutual_info, rank, 1000000 FROM ranked
  WHERE feature = 'ticker_mean_return_30d' AND feature NOT IN (SELECT feature FROM sel))
SELECT feature, mutual_info, CAST(rank AS INTEGER) AS rank, CAST(row_number() OVER (ORDER BY position) AS INTEGER) AS position FROM sel2""")
def q_select(spark, sf_dir):
    tr = _train_features(spark, sf_dir)
    products = Sel.column_products(tr, FEATS)           # the ranges come with them
    mi = Sel.binned_mutual_information(tr, FEATS, ranges=Sel.product_ranges(products, FEATS))
    pairs = Sel.correlated_pairs(tr, FEATS, parts=products)
    out = Sel.select_features(mi, pairs, FEATS)
    return out.select("feature", "mutual_info", F.col("rank").cast("int"), F.col("position").cast("int"))


_FIT = f"""{_TRAIN},
fit AS (SELECT UNNEST([""" + ", ".join(
    f"{{'feature': '{c}', 'mean': coalesce(avg(\"{c}\"), 0.0), "
    f"'scale': CASE WHEN stddev_pop(\"{c}\") IS NULL OR stddev_pop(\"{c}\") = 0 THEN 1.0 ELSE stddev_pop(\"{c}\") END}}"
    for c in FEATS) + "], recursive := true) FROM tr)"


@register("scaler_fit", _BASE + _FIT + """
SELECT feature, round(mean, 6) + 0.0 AS mean, round(scale, 6) + 0.0 AS scale FROM fit""")
def q_scaler_fit(spark, sf_dir):
    t = S.scaler_table(_train_features(spark, sf_dir), FEATS)
    return t.select("feature", (F.round("mean", 6) + 0.0).alias("mean"), (F.round("scale", 6) + 0.0).alias("scale"))


_STATS = f"""{_TRAIN},
st AS (SELECT """ + ", ".join(
    f"coalesce(avg(\"{c}\"), 0.0) AS m{i}, CASE WHEN stddev_pop(\"{c}\") IS NULL OR stddev_pop(\"{c}\") = 0 "
    f"THEN 1.0 ELSE stddev_pop(\"{c}\") END AS s{i}" for i, c in enumerate(FEATS)) + " FROM tr)"


# the statistics and the rows both read feat: computed once
@register("scaled_features", _BASE.replace("feat AS (", "feat AS MATERIALIZED (") + _STATS + """
SELECT split, "Ticker", "Date", """ + ", ".join(
    f'round((CAST("{c}" AS DOUBLE) - m{i}) / s{i}, 6) + 0.0 AS "{c}"' for i, c in enumerate(FEATS)) + " FROM feat, st")
def q_scaled(spark, sf_dir):
    """The features are computed twice, for the fit and for the result, and not written between."""
    p = panel(spark, sf_dir)
    stats = S.fit_scaler(feature_cells(p.where(F.col("split") == "train"), assume_clean=True), FEATS)
    out = S.apply_scaler(build_features(p, assume_clean=True).select("split", "Ticker", "Date", *FEATS), stats)
    return out.select("split", "Ticker", "Date", *[rounded(c, 6).alias(c) for c in FEATS])


@register("scaling_cell_stats", _BASE + _STATS + """,
sc AS (SELECT """ + ", ".join(f'(CAST("{c}" AS DOUBLE) - m{i}) / s{i} AS "{c}"' for i, c in enumerate(FEATS))
    + """ FROM feat, st)
SELECT 'before' AS stage, round(least(""" + ", ".join(f'min("{c}")' for c in FEATS) + "), 3) + 0.0 AS min, round(greatest("
    + ", ".join(f'max("{c}")' for c in FEATS) + "), 3) + 0.0 AS max, round((" + " + ".join(f'sum("{c}")' for c in FEATS)
    + f") / (count(*) * {len(FEATS)}), 6) + 0.0 AS mean FROM feat\nUNION ALL SELECT 'after', round(least("
    + ", ".join(f'min("{c}")' for c in FEATS) + "), 6) + 0.0, round(greatest(" + ", ".join(f'max("{c}")' for c in FEATS)
    + "), 6) + 0.0, round((" + " + ".join(f'sum("{c}")' for c in FEATS) + f") / (count(*) * {len(FEATS)}), 6) + 0.0 FROM sc")
def q_cell_stats(spark, sf_dir):
    p = panel(spark, sf_dir)
    stats = S.fit_scaler(feature_cells(p.where(F.col("split") == "train"), assume_clean=True), FEATS)
    found = S.scaled_cell_stats(feature_cells(p, assume_clean=True), FEATS, stats)
    ends = [F.when(F.col("stage") == "before", F.round(c, 3)).otherwise(F.round(c, 6)) + 0.0 for c in ("min", "max")]
    return found.select("stage", ends[0].alias("min"), ends[1].alias("max"), (F.round("mean", 6) + 0.0).alias("mean"))
