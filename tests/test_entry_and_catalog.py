import __spark_entry__ as E
from tessera.plans.catalog import REGISTRY

from conftest import SF


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 136


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def test_training_data_queries_are_optional(monkeypatch):
    """Without the subpackage and the pipeline module the other queries remain."""
    import sys
    own = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(E.queries()) == set(REGISTRY) and own.isdisjoint(REGISTRY)
    assert set(E.oracle_sql()) <= set(REGISTRY)


def test_no_cached_table_in_any_plan(spark):
    for name in ("features_all", "split_panel", "sequences_sliding", "eval_binary_metrics"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" not in plan


def test_every_query_plans(spark):
    # analysis only: every query that runs no job while planning resolves against the tables
    for name in E.queries():
        if name in REGISTRY and not name.startswith(("fit_", "eval_", "select_", "scal", "loss_", "batchnorm_apply", "event_",
                                                     "position_split", "sequences_", "sample_", "submission", "model_")):
            assert E.queries()[name](spark, SF).schema is not None
