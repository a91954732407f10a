"""P3 with a saved model: bars are cleaned once, and only the features that the model reads are computed."""

from pyspark.sql import functions as F

from helpers import panel_df, panel_rows, random_walk
from tessera.operators import features as Fe
from tessera.plans import pipelines as Pl
from tessera.plans.process import clean_table, process, split_panel

NAMES = ["rsi", "return_10d", "ticker_mean_return_30d"]


def test_split_panel_equals_process(spark):
    rows = [r for i, n in enumerate((20, 31, 60, 200)) for r in panel_rows(f"T{i}", random_walk(n, i))]
    rows += [(r[0], "G", *[None if j % 7 == k else v for k, v in enumerate(r[2:])]) for j, r in enumerate(panel_rows("G", random_walk(90, 9)))]
    raw = panel_df(spark, rows)
    clean = clean_table(raw)
    want, got = process(raw), split_panel(clean)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(Ticker") == 0


def test_scores_compute_the_features_of_the_model(spark, monkeypatch):
    raw = panel_df(spark, [r for i in range(3) for r in panel_rows(f"T{i}", random_walk(120, i))])
    requests = spark.createDataFrame([("T0",), ("T2",), ("X",)], "ID string").withColumn("Date", F.lit(None).cast("date"))
    wanted, statistics = [], Fe.with_statistics
    monkeypatch.setattr(Fe, "with_statistics", lambda df, names, number: wanted.append(set(names)) or statistics(df, names, number))
    stats = {c: (0.0, 1.0) for c in NAMES}
    out = Pl.score_requests(clean_table(raw), requests, NAMES, stats, [0.1, 0.2, 0.3])
    assert {r.ID: r.Pred for r in out.collect()}.keys() == {"T0", "T2", "X"}
    assert wanted == [{"_avg_gain", "_avg_loss", "_lagc10"}]         # not all 57 statistics
