import datetime as dt

import numpy as np
import pandas as pd

PANEL_SCHEMA = ("Date date, Ticker string, Open double, High double, Low double, Close double, "
                "Volume double, Dividends double, `Stock Splits` double")


def business_days(n, start=dt.date(2020, 1, 1)):
    days, d = [], start
    while len(days) < n:
        if d.weekday() < 5:
            days.append(d)
        d += dt.timedelta(days=1)
    return days


def panel_rows(ticker, closes, volumes=None, opens=None, start=dt.date(2020, 1, 1)):
    days = business_days(len(closes), start)
    volumes = volumes if volumes is not None else [100.0] * len(closes)
    opens = opens if opens is not None else closes
    rows = []
    for d, c, v, o in zip(days, closes, volumes, opens):
        hi = None if c is None else c * 1.01
        lo = None if c is None else c * 0.99
        rows.append((d, ticker, o, hi, lo, c, v, 0.0, 0.0))
    return rows


def panel_df(spark, rows):
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def random_walk(n, seed, start=100.0):
    rng = np.random.default_rng(seed)
    return [float(v) for v in start * np.exp(np.cumsum(rng.normal(0, 0.02, n)))]


def to_pandas_sorted(df, by):
    return df.toPandas().sort_values(by).reset_index(drop=True)


__all__ = ["pd", "np"]
