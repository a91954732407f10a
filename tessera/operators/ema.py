"""Exponential moving averages (E7) and MACD (I4) as pure window plans.

The recursion y0 = x0, y_t = b*y_{t-1} + a*x_t (a = 2/(span+1), b = 1-a;
``adjust=False``) is a linear scan.  It is evaluated by recursive quadrupling:
with y_t = b^d * y_{t-d} + B_d(t),

    B_1(t)  = a * x_t
    B_4d(t) = B_d(t) + b^d * B_d(t-d) + b^2d * B_d(t-2d) + b^3d * B_d(t-3d)

so each level is three ``lag``s in the series window.  Rows before the
series start behave like a constant run of x0 (which is what seeding y0 = x0
means), i.e. B_d = x0 * (1 - b^d) there.  After L levels the remaining
term b^(4^L) * y is below ``tol`` relative to the level, so L ~ log4(ln(tol)
/ ln(b)) -- 5 levels for span 26, 4 for spans 12 and 9.

Levels are computed on the arrays of whole series (``series``), O(n log span)
work; ``running_ema`` does the same with windows over chunks, for series of any
length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import carry, running_sums
from tessera.operators.series import TOL, levels_for, numbered, with_statistics
from tessera.operators.windows import CHUNK_ROWS, _list, copies_in_chunks

# Fixed values (MACD spans).
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9


def averaged(value: str) -> Column:
    """The column as moving averages take it: a NULL fails the job."""
    return F.coalesce(F.col(value).cast("double"),
                      F.raise_error(F.lit(f"the moving average of {value} needs a value in every row")).cast("double"))


def with_ema(df: DataFrame, value: str, spans: Sequence[int], keys="Ticker", order="Date",
             names: Sequence[str] | None = None, tol: float = TOL) -> DataFrame:
    """Append one EMA column per span (default names ``ema_{span}``).

    Values of 4^levels rows ago weigh less than ``tol`` of the sum and are left
    out: exact to double precision for values of one magnitude.  A NULL value
    fails the job; fill the column first.
    """
    names = list(names or [f"ema_{s}" for s in spans])
    rows = numbered(df.withColumn("__ema_x", averaged(value)), _list(keys), _list(order), "__number")
    wanted = {n: ("__ema_x", s, "ema", tol) for n, s in zip(names, spans)}
    return with_statistics(rows, wanted, "__number").drop("__ema_x", "__number")


def running_ema(df: DataFrame, value: str, spans: Sequence[int], keys, order, names: Sequence[str] | None = None,
                tol: float = TOL, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """E7 on raw-row series with gaps: one EMA column per span (default ``ema_{span}``).

    A value that comes g rows after the one before it gives
    y = (b^g * y_before + a * x) / (b^g + a), which is ``ewm(span, adjust=False)`` with its default
    weights across gaps; rows without a value (NULL or NaN) repeat the last average, and are NULL
    before the first value.  The step is affine in y_before, and affine steps compose, so the
    values of a series, numbered through ranges, are cut into chunks with a halo in front, and in
    each chunk steps are composed by fours with ``lag``s.  A step keeps at most b of what was
    before, so what lies beyond the halo weighs less than ``tol``.  Rows without a value are
    filled range by range afterwards.  No series, however long, has to fit a task, and neither
    has a run of rows without values.  ``order`` should be unique within a series.
    """
    keys, order = _list(keys), _list(order)
    names = list(names or [f"ema_{s}" for s in spans])
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    placed = running_sums(df.withColumns({"__x": x, "__one": F.lit(1), "__seen": x.isNotNull().cast("long")}),
                          keys, order, ["__one", "__seen"])
    levels = {s: levels_for(s, tol) for s in spans}
    seen = placed.where(F.col("__seen") == 1).withColumn("_pos", F.col("cum___seen") - 1)
    out = copies_in_chunks(seen, 4 ** max(levels.values()), 0, chunk_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    out = out.withColumn("__gap", F.col("cum___one") - F.lag("cum___one").over(w))
    first = F.col("__gap").isNull()
    for i, s in enumerate(spans):
        alpha = 2.0 / (s + 1.0)
        kept = F.pow(F.lit(1.0 - alpha), F.col("__gap"))
        out = out.withColumns({f"__a{i}": F.when(first, F.lit(0.0)).otherwise(kept / (kept + F.lit(alpha))),
                               f"__b{i}": F.when(first, F.col("__x")).otherwise(
                                   F.lit(alpha) * F.col("__x") / (kept + F.lit(alpha)))})
    for level in range(max(levels.values())):
        back = lambda c: [F.col(c)] + [F.coalesce(F.lag(c, k * 4 ** level).over(w), F.lit(0.0))  # noqa: B023, E731
                                       for k in (1, 2, 3)]
        step = {}
        for i, s in enumerate(spans):
            if level < levels[s]:
                a, b = back(f"__a{i}"), back(f"__b{i}")
                step[f"__b{i}"] = b[0] + a[0] * (b[1] + a[1] * (b[2] + a[2] * b[3]))
                if level + 1 < levels[s]:
                    step[f"__a{i}"] = a[0] * a[1] * a[2] * a[3]
        out = out.withColumns(step)
    own = [F.col(f"`{c}`") for c in df.columns]
    averages = F.struct(*[F.col(f"__b{i}").alias(f"b{i}") for i in range(len(spans))])
    kind = "struct<" + ",".join(f"b{i}:double" for i in range(len(spans))) + ">"
    valued = out.where(~F.col("_halo")).select(*own, averages.alias("__ema"))
    without = placed.where(F.col("__seen") == 0).select(*own, F.lit(None).cast(kind).alias("__ema"))
    filled = carry(valued.unionByName(without), "__ema", keys, order)
    return filled.select(*own, *[F.col(f"__ema.b{i}").alias(n) for i, n in enumerate(names)])


def macd_statistics(value: str, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL) -> dict[str, tuple]:
    """I4 for ``series.with_statistics``: macd = EMA_fast - EMA_slow, macd_signal = EMA_signal(macd),
    macd_histogram = macd - macd_signal, of a column ``averaged``."""
    return {"__ema_fast": (value, fast, "ema"), "__ema_slow": (value, slow, "ema"),
            "macd": ("__ema_fast", "__ema_slow", "minus"), "macd_signal": ("macd", signal, "ema"),
            "macd_histogram": ("macd", "macd_signal", "minus")}


def with_macd(df: DataFrame, close: str = "Close", keys="Ticker", order="Date",
              fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL) -> DataFrame:
    """I4: ``df`` with macd, macd_signal and macd_histogram."""
    rows = numbered(df.withColumn("__ema_x", averaged(close)), _list(keys), _list(order), "__number")
    wanted = macd_statistics("__ema_x", fast, slow, signal)
    return with_statistics(rows, wanted, "__number").drop("__ema_x", "__number", "__ema_fast", "__ema_slow")
