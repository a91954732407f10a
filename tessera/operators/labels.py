"""Forward labels (J1) and the generic multi-step target (J9 helper)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.clean import HORIZON, series_window


def forward_label(df: DataFrame, keys="Ticker", order="Date", value: str = "Close",
                  horizon: int = HORIZON, target: str = "target") -> DataFrame:
    """target = 1 if value(t + horizon rows) > value(t) else 0 (ties -> 0).

    The last ``horizon`` rows of each series have no future value and are
    dropped.  ``lead`` runs in the series window, so no join is needed.
    """
    fut = F.lead(F.col(value), horizon).over(series_window(keys, order))
    return (df.withColumn("_future", fut)
            .where(F.col("_future").isNotNull())
            .withColumn(target, (F.col("_future") > F.col(value)).cast("int"))
            .drop("_future"))


def label_distribution(df: DataFrame, by=None, target: str = "target") -> DataFrame:
    """Count and percentage per class, overall or per group (e.g. split).

    The percentage is a window over the (tiny) aggregated result.
    """
    from pyspark.sql import Window
    group = ([by] if isinstance(by, str) else list(by or []))
    counts = df.groupBy(*group, target).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*group)) if group else F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 6))
