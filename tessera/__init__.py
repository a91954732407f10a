"""tessera — panel time-series analytics expressed as Spark DataFrame plans.

Many keyed series (a *panel*), each ordered by date, are turned into cleaned
bars, forward labels, date-ordered splits, rolling / lagged / exponential /
calendar / regime features, feature rankings, scaled tables and fixed-length
sequences; binary forecasts over them are scored and evaluated (losses,
confusion tables, ROC / PR curves, threshold choice, per-series and
per-period reports).

Everything is a ``DataFrame -> DataFrame`` transformation.  Column names for
the series key, the order key and the value columns are parameters, so the
operators are not tied to stock data.
"""

__version__ = "0.1.0"
