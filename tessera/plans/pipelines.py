"""P2 and P3 composed end to end.

P2: features -> non-finite to 0 -> scaler fitted on train -> written -> read
back -> fixed-length sequences.  P3: requested history -> last rows ->
causal features -> the fitted scaler -> latest sequence -> score -> median
threshold -> submission.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import rounded, sigmoid
from tessera.operators import scaling as S
from tessera.operators import sequences as Q
from tessera.operators import submission as Sub
from tessera.operators.clean import non_finite_to_zero, require_columns
from tessera.operators.features import build_features
from tessera.operators.fit import probabilities
from tessera.operators.metrics import median_threshold_predictions
from tessera.operators.windows import last_n_rows
from tessera.session import materialize

HISTORY_ROWS = 250       # fixed values: rows of history per request, length of a sequence
SEQUENCE = 20


def selected_features(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys, label and the selected features, finite everywhere."""
    names = require_columns(features, names)
    keys = [c for c in ("split", "Ticker", "Date", "target") if c in features.columns]
    return non_finite_to_zero(features.select(*keys, *names), names)


def fit_and_scale(features: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict]:
    """The scaled feature table, written once, and the scaler fitted on its train rows."""
    rows = materialize(selected_features(features, names))
    scaler = S.fit_scaler(rows.where(F.col("split") == "train"), names)
    return materialize(S.apply_scaler(rows, scaler)), scaler


def training_sequences(features: DataFrame, names: Sequence[str], length: int = SEQUENCE,
                       digits: int | None = None) -> DataFrame:
    """(split, Ticker, Date, X, y), scaled values rounded to ``digits``: each once, not once in every
    sequence that holds it."""
    scaled, _ = fit_and_scale(features, names)
    if digits is not None:
        scaled = scaled.withColumns({c: rounded(c, digits) for c in names})
    return Q.sliding_sequences(scaled, names, length, keys=["split", "Ticker"])


def linear_score(x: str, weights: Sequence[float]) -> Column:
    """sigmoid of the weighted features, averaged over the steps of a sequence."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    step = lambda v: F.aggregate(F.zip_with(v, w, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    total = F.aggregate(F.transform(F.col(x), step), F.lit(0.0), lambda a, b: a + b)
    return sigmoid(total / F.size(x))


def score_requests(history: DataFrame, requests: DataFrame, names: Sequence[str], scaler: dict,
                   weights: Sequence[float], rows: int = HISTORY_ROWS, length: int = SEQUENCE) -> DataFrame:
    """(ID, Pred) for every request, 0 where the history is unknown or too short."""
    recent = last_n_rows(Sub.keep_requested(history, requests), rows)
    features = build_features(recent, keys=["Ticker"], stats="expanding", assume_clean=True, only=names)
    scaled = S.apply_scaler(selected_features(features, names), scaler)
    scored = Q.latest_sequence(scaled, names, length).select(
        "Ticker", "Date", linear_score("X", weights).alias("Probability"))
    return Sub.assemble_submission(requests, median_threshold_predictions(materialize(scored)))


def score_with_model(history: DataFrame, requests: DataFrame, names: Sequence[str], model, rows: int = HISTORY_ROWS,
                     length: int = SEQUENCE) -> DataFrame:
    """P3 with a saved model: (Ticker, Date, Probability) of the requested series, the mean of the
    model's probabilities over the last ``length`` rows.  The model brings its own scaler."""
    recent = last_n_rows(Sub.keep_requested(history, requests), rows)
    features = selected_features(build_features(recent, keys=["Ticker"], stats="expanding", assume_clean=True, only=names),
                                 names)
    last = last_n_rows(features, length)
    per_series = probabilities(model, last).groupBy("Ticker").agg(
        F.max("Date").alias("Date"), F.avg("Probability").alias("Probability"), F.count(F.lit(1)).alias("n"))
    return per_series.where(F.col("n") == length).drop("n")


def submit_with_model(history: DataFrame, requests: DataFrame, names: Sequence[str], model) -> DataFrame:
    """P3 with a saved model: (ID, Pred) for every request."""
    return Sub.assemble_submission(requests, median_threshold_predictions(
        materialize(score_with_model(history, requests, names, model))))
