"""Scalar column functions (JVM-side expressions, no Python UDFs).

Null model: NULL is the only "missing" marker.  Divisions that could hit a
zero divisor use ``try_divide`` (ANSI mode raises otherwise), which yields
NULL exactly where pandas would produce ``inf`` or ``NaN``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
EPS = 1e-8            # guard added to divisors of ratio features
SIGMOID_CLIP = 500.0  # logits are clipped to +-500 before exp


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / den`` that is NULL (not an error, not inf) when ``den`` is 0."""
    return F.try_divide(col(num), col(den))


def eps_div(num, den, eps: float = EPS) -> Column:
    """The reference's guarded ratio ``num / (den + eps)``."""
    return F.try_divide(col(num), col(den) + F.lit(eps))


def rounded(c, digits: int) -> Column:
    """``F.round`` of a double, the same numbers (and no -0.0) at a tenth of the cost.

    Spark rounds a double by way of its decimal text.  Away from a tie (and below 2^40 units) the
    nearest whole number of units is the same either way, and so is its quotient; what lies
    within a thousandth of a tie, and NaN, takes Spark's way.
    """
    x, unit = col(c), F.lit(float(10 ** digits))
    whole = F.rint(x * unit)
    plain = (F.abs(whole) < F.lit(float(2 ** 40))) & (F.abs(x * unit - whole) < F.lit(0.499))
    return F.when(plain, (whole + F.lit(0.0)) / unit).otherwise(F.round(x, digits) + F.lit(0.0))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 integer; an unknown comparison (NULL input) is 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def clip(c, lo: float, hi: float) -> Column:
    return F.greatest(F.least(col(c), F.lit(hi)), F.lit(lo))


def sigmoid(c) -> Column:
    x = clip(c, -SIGMOID_CLIP, SIGMOID_CLIP)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(c) -> Column:
    return F.greatest(col(c), F.lit(0.0))


def tanh(c) -> Column:
    return F.tanh(col(c))


# ---- array (vector) helpers -------------------------------------------------

def softmax(arr) -> Column:
    """Softmax of an ``array<double>`` with the max shifted out first."""
    a = col(arr)
    m = F.array_max(a)
    ex = F.transform(a, lambda v: F.exp(v - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(ex, lambda v: v / total)


def one_hot(index, k: int) -> Column:
    """Vector of ``k`` values; an index outside 0 .. k-1 fails the job."""
    hot = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == col(index)).cast("double"))
    inside = (col(index) >= 0) & (col(index) < k)
    return F.when(inside | col(index).isNull(), hot).otherwise(
        F.raise_error(F.concat(F.lit(f"one-hot index outside 0 .. {k - 1}: "), col(index).cast("string"))))


def argmax(arr) -> Column:
    """0-based position of the first maximum."""
    a = col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")
