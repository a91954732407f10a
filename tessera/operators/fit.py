"""Model fitting as Spark jobs.

A gradient over a table is one ``groupBy().agg(sum(...))``; only the few
model numbers live on the driver.  Models are ``pyspark.ml`` pipelines, so they
are saved, loaded and applied as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_weights(df: DataFrame, target: str = "target") -> DataFrame:
    """D5: "balanced" weights n / (k * n_c) per class (k = number of classes seen)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the k (<= a handful) aggregated rows
    return counts.withColumn(
        "weight", F.round(F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n")), 10))


# ---- logistic model (M3, M4) ---------------------------------------------------

def logistic_gradient(df: DataFrame, features, w, b: float, target: str = "target",
                      weight: str | None = None):
    """M4: gradient of the mean (optionally class-weighted) log-loss of
    sigmoid(x.w + b) in one aggregate; one number per feature reaches the
    driver.  Returns (grad_w dict, grad_b, n, loss)."""
    from tessera.functions.scalar import sigmoid
    z = F.lit(float(b))
    for c, wc in zip(features, w):
        z = z + F.col(c).cast("double") * F.lit(float(wc))
    p = sigmoid(z)
    wt = F.col(weight) if weight else F.lit(1.0)
    y = F.col(target).cast("double")
    r = wt * (p - y)
    loss = wt * -(y * F.log(F.greatest(p, F.lit(1e-8))) + (1 - y) * F.log(F.greatest(1 - p, F.lit(1e-8))))
    got = df.agg(*[F.sum(F.col(c).cast("double") * r).alias(f"g{i}") for i, c in enumerate(features)],
                 F.sum(r).alias("g"), F.sum(loss).alias("l"), F.count(F.lit(1)).alias("n")).first()
    n = got["n"]
    return {c: got[f"g{i}"] / n for i, c in enumerate(features)}, got["g"] / n, n, got["l"] / n


def fit_ml_logistic(train: DataFrame, features, target: str = "target", weight: str | None = "weight",
                    reg: float = 0.001):
    """M3: ``pyspark.ml`` logistic regression with class weights and L2."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol="features_vec", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="features_vec", labelCol=target, weightCol=weight, regParam=reg,
                            elasticNetParam=0.0, maxIter=50)
    model = lr.fit(va.transform(train))
    return va, model


def with_balanced_weight(df: DataFrame, target: str = "target", boost0: float = 1.0) -> DataFrame:
    """D5 weights as a column (the class-0 weight optionally boosted); one number per class,
    applied as literals."""
    from tessera.operators.ranges import with_group_values
    cw = class_weights(df, target).select(
        target, (F.col("weight") * F.when(F.col(target) == 0, F.lit(boost0)).otherwise(F.lit(1.0))).alias("weight"))
    return with_group_values(df, cw, [target], ["weight"])


# ---- a model with its scaler, saved and read back (A7, A8, P3) --------------------

def scaling_pipeline(train: DataFrame, features: Sequence[str], target: str = "target", weight: str | None = None,
                     reg: float = 0.001):
    """The fitted pipeline: population scaling of ``features`` (K4), assembler, logistic regression.

    ``pyspark.ml``'s own scaler divides by the sample deviation; here the scaling is a projection
    (``SQLTransformer``) that holds the fitted means and deviations in full precision.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    from tessera.operators.scaling import fit_scaler
    stats = fit_scaler(train, features)
    scaled = [f"(CAST(`{c}` AS DOUBLE) - ({stats[c][0]!r}D)) / {stats[c][1]!r}D AS `_scaled_{i}`"
              for i, c in enumerate(features)]
    columns = [f"_scaled_{i}" for i in range(len(features))]
    settings = {"weightCol": weight} if weight else {}
    return Pipeline(stages=[
        SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"),
        VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="error"),
        LogisticRegression(featuresCol="_features", labelCol=target, regParam=reg, maxIter=100, tol=1e-9,
                           probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class", **settings),
    ]).fit(train)


def save_model(model, path: str) -> None:
    """The whole fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """A8."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def probabilities(model, rows: DataFrame, name: str = "Probability") -> DataFrame:
    """``rows`` with the model's probability of class 1; nothing is fitted."""
    from pyspark.ml.functions import vector_to_array
    return model.transform(rows).select(*rows.columns, vector_to_array("_probability")[1].alias(name))


# ---- grid search, early stopping, history (M5-M7) ----------------------------------

def assembled(rows: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, _features): one vector per row."""
    from pyspark.ml.feature import VectorAssembler
    cells = rows.select(*keep, *[F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    return VectorAssembler(inputCols=[f"_f{i}" for i in range(len(features))], outputCol="_features",
                           handleInvalid="error").transform(cells).select(*keep, "_features")


def validation_scores(model, val: DataFrame, target: str = "target") -> tuple[float, float]:
    """(accuracy in percent, mean log-loss) of a fitted ``pyspark.ml`` classifier."""
    from pyspark.ml.functions import vector_to_array

    from tessera.operators.losses import bce
    scored = model.transform(val).select(vector_to_array(model.getProbabilityCol())[1].alias("p"),
                                         F.col(target).cast("double").alias("y"))
    got = scored.agg((F.avg(((F.col("p") > 0.5).cast("double") == F.col("y")).cast("double")) * 100).alias("a"),
                     bce("p", F.col("y")).alias("l")).first()
    return float(got["a"]), float(got["l"])


def grid_search(estimator, grid: Sequence[dict], train: DataFrame, val: DataFrame, target: str = "target",
                parallelism: int = 4):
    """M6: every point of ``grid`` (from ``ParamGridBuilder``) fitted on ``train`` and judged on ``val``.

    Points run ``parallelism`` at a time, as Spark's own validators run them, but a point that fails
    is recorded and skipped instead of ending the search, and the validation rows are the given ones
    (later dates), not random.  Returns (best model, refitted; report): the report has one row per
    point, ranked by validation accuracy, the first of equals before the others; failed points last.
    """
    from pyspark import inheritable_thread_target
    spark = train.sparkSession

    def judged(point: tuple[int, dict]) -> tuple:
        number, params = point
        shown = {p.name: v for p, v in params.items()}
        try:
            accuracy, loss = validation_scores(estimator.fit(train, params), val, target)
            return number, str(shown), accuracy, loss, None
        except Exception as e:  # noqa: BLE001 -- the point's failure is the result
            return number, str(shown), None, None, f"{type(e).__name__}: {e}"[:300]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(judged), enumerate(grid)))
    good = sorted((r for r in rows if r[4] is None), key=lambda r: (-r[2], r[0]))
    if not good:
        raise RuntimeError(f"no point of the grid could be fitted; the first failed with {rows[0][4] if rows else 'nothing'}")
    ranked = [(*r, i + 1) for i, r in enumerate(good)] + [(*r, None) for r in rows if r[4] is not None]
    report = spark.createDataFrame(ranked, "point int, params string, val_accuracy double, val_loss double, "
                                           "error string, rank int")
    return estimator.fit(train, grid[good[0][0]]), report


def boosted_trees(rows: DataFrame, is_validation: str, target: str = "target", trees: int = 60, depth: int = 3,
                  step: float = 0.1, tolerance: float = 0.01, seed: int = 42):
    """M5, M3's tree option: gradient-boosted trees on (_features, ``target``), which stop when the
    loss on the rows flagged by ``is_validation`` no longer falls by ``tolerance`` (relative); the
    model keeps the trees up to the best iteration."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(featuresCol="_features", labelCol=target, maxIter=trees, maxDepth=depth, stepSize=step,
                         validationIndicatorCol=is_validation, validationTol=tolerance, seed=seed).fit(rows)


def boosting_history(model, train: DataFrame, val: DataFrame) -> DataFrame:
    """M7: (iteration, split, loss) of boosted trees, mean log-loss per row after each tree.  Spark
    reports 2 log(1 + exp(-2 y f)), twice the log-loss of the probability it returns."""
    rows = [(i + 1, split, loss / 2) for split, part in (("train", train), ("val", val))
            for i, loss in enumerate(model.evaluateEachIteration(part))]
    return train.sparkSession.createDataFrame(rows, "iteration int, split string, loss double")


def logistic_history(spark, model) -> DataFrame:
    """M7: (iteration, split, loss) of a logistic regression; iteration 0 is the start."""
    losses = model.summary.objectiveHistory
    return spark.createDataFrame([(i, "train", float(x)) for i, x in enumerate(losses)],
                                 "iteration int, split string, loss double")
