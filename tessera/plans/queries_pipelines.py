"""Queries over the composed pipelines P2 and P3."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import fit as Fit
from tessera.operators.clean import handle_missing_values
from tessera.operators.features import build_features
from tessera.plans import pipelines as Pl
from tessera.plans.catalog import register
from tessera.plans.oracle_sql import PANEL_CTES, feature_sql, with_
from tessera.plans.process import clean_table, split_panel
from tessera.plans.queries_features import features_table
from tessera.plans.queries_model import _REQ
from tessera.sources.bars import load_bars, scoring_requests
from tessera.session import materialize, shared_folder
from tessera.sources.tables import read_table

# a selected feature list and the weights of a fixed linear score over it
SELECTED = ["rsi", "price_position_50", "return_10d", "ticker_mean_return_30d", "close_to_ma_50", "volatility_pct_30"]
WEIGHTS = [0.4, -0.7, 0.3, 0.9, -0.2, 0.1]

_SCALER = "st AS (SELECT " + ", ".join(
    f"avg(\"{c}\") AS m{i}, CASE WHEN stddev_pop(\"{c}\") = 0 THEN 1.0 ELSE stddev_pop(\"{c}\") END AS s{i}"
    for i, c in enumerate(SELECTED)) + " FROM feat WHERE split = 'train')"


def _scaled(table: str) -> str:
    return ", ".join(f'(CAST({table}."{c}" AS DOUBLE) - m{i}) / s{i} AS f{i}' for i, c in enumerate(SELECTED))


_VEC = "[" + ", ".join(f"f{i}" for i in range(len(SELECTED))) + "]"


@register("scaled_selected_sequences", with_(*PANEL_CTES, feature_sql(), _SCALER) + f""",
sc AS (SELECT split, "Ticker", "Date", target, {_scaled("feat")} FROM feat, st)
SELECT split, "Ticker", "Date", list_transform("X", lambda v: list_transform(v, lambda x: round(x, 5) + 0.0)) AS "X", y FROM (
  SELECT split, "Ticker", "Date", list({_VEC}) OVER w AS "X", CAST(target AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY split, "Ticker" ORDER BY "Date") AS rn FROM sc
  WINDOW w AS (PARTITION BY split, "Ticker" ORDER BY "Date" ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE rn >= 20""")
def q_training_sequences(spark, sf_dir):
    """Sequences of 20 steps of the scaled, selected features."""
    return Pl.training_sequences(features_table(spark, sf_dir, SELECTED), SELECTED, digits=5)


_DOT = " + ".join(f"{w!r}::DOUBLE * f{i}" for i, w in enumerate(WEIGHTS))


@register("submission_from_history", with_(*PANEL_CTES, feature_sql(), _SCALER, _REQ) + f""",
hist AS (SELECT * EXCLUDE (r), 'train' AS split, 0 AS target FROM (
  SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS r FROM clean
  WHERE "Ticker" IN (SELECT "ID" FROM req)) WHERE r <= 250),
{feature_sql("hist", "h_")},
hs AS (SELECT "Ticker", "Date", {_scaled("h_feat")} FROM h_feat, st),
sq AS (SELECT "Ticker", count(*) AS n, 1.0 / (1.0 + exp(-avg({_DOT}))) AS p FROM (
  SELECT *, row_number() OVER (PARTITION BY "Ticker" ORDER BY "Date" DESC) AS r FROM hs) WHERE r <= 20 GROUP BY "Ticker"),
lt AS (SELECT * FROM sq WHERE n = 20)
SELECT r."ID", CAST(coalesce(CAST(p > (SELECT median(p) FROM lt) AS INTEGER), 0) AS INTEGER) AS "Pred"
FROM req r LEFT JOIN lt ON lt."Ticker" = r."ID" """)
def q_submission_from_history(spark, sf_dir):
    """Every request scored from its last 250 rows of history."""
    _, scaler = Pl.fit_and_scale(features_table(spark, sf_dir, SELECTED), SELECTED)
    history = handle_missing_values(load_bars(spark, sf_dir))
    requests = scoring_requests(read_table(spark, sf_dir, "supplier"))
    return Pl.score_requests(history, requests, SELECTED, scaler, WEIGHTS)


@register("submission_saved_model")
def q_submission_saved_model(spark, sf_dir):
    """P3 with a model fitted once on train, saved with its scaler, and read back."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    history = clean_table(load_bars(spark, sf_dir))
    rows = split_panel(history).where(F.col("split") == "train")
    train = Pl.selected_features(build_features(rows, assume_clean=True, only=SELECTED), SELECTED)
    Fit.save_model(Fit.scaling_pipeline(materialize(train), SELECTED), path)
    requests = scoring_requests(read_table(spark, sf_dir, "supplier"))
    return Pl.submit_with_model(history, requests, SELECTED, Fit.load_model(path))
