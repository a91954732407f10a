"""Registered queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL | None).

Every query reads the given tables (or data Spark derives from them) in
full; none runs on a fixed, made-up input.  Queries without SQL are checked
for rows only by the driver and against brute force in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tessera.plans import (queries_panel, queries_features, queries_eval,  # noqa: F401
                               queries_selection, queries_sequences, queries_model, queries_pipelines)
