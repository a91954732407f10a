"""Raw panel -> cleaned, labelled, split panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.clean import handle_missing_values
from tessera.operators.labels import forward_label
from tessera.operators.splits import check_ratios, split_by_date
from tessera.session import series_table


def labelled_panel(raw: DataFrame, keys="Ticker", order="Date", horizon: int = 30) -> DataFrame:
    """B13 then J1.  Both run in windows on the same series partitioning."""
    clean = handle_missing_values(raw, keys, order, min_rows=horizon + 1)
    return forward_label(clean, keys, order, horizon=horizon)


def process(raw: DataFrame, train: float = 0.7, val: float = 0.15, test: float = 0.15,
            keys="Ticker", order="Date", horizon: int = 30) -> DataFrame:
    """Cleaned + labelled panel with a ``split`` column (train / val / test).

    The raw rows are read, cleaned and labelled once: the labelled panel is written by series, the
    dates of the split are ranked from it, and windows on the result need no exchange.  The
    reference's ``full`` frame is the same DataFrame without the filter on ``split``.
    """
    check_ratios(train, val, test)
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    labelled = series_table(labelled_panel(raw, keys, order, horizon), keys, order)
    return split_by_date(labelled, order[0], train, val, test)


def clean_table(raw: DataFrame, keys="Ticker", order="Date", horizon: int = 30) -> DataFrame:
    """B13 written by series, for passes over the labelled rows (``split_panel``) and over the whole history."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return series_table(handle_missing_values(raw, keys, order, min_rows=horizon + 1), keys, order)


def split_panel(clean: DataFrame, train: float = 0.7, val: float = 0.15, test: float = 0.15,
                keys="Ticker", order: str = "Date", horizon: int = 30) -> DataFrame:
    """J5 from a ``clean_table``: what ``process`` returns, labelled anew in every pass, without an exchange."""
    return split_by_date(forward_label(clean, keys, order, horizon=horizon), order, train, val, test)
