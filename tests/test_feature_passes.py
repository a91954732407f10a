"""Summaries of features run in the task that fills them; the nearest-neighbour estimate takes features in turns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import panel_df, panel_rows, random_walk
from tessera import session
from tessera.operators import scaling as S
from tessera.operators import selection as Sel
from tessera.operators.features import build_features, feature_cells, feature_names

NAMES = feature_names()


@pytest.fixture(scope="module")
def panel(spark):
    rows = [r for i, t in enumerate("ABCD") for r in panel_rows(t, random_walk(80 + 90 * i, i), volumes=random_walk(80 + 90 * i, 9 + i))]
    df = panel_df(spark, rows).withColumn("split", F.when(F.col("Date") < "2020-10-01", "train").otherwise("val"))
    return df.withColumn("target", F.pmod(F.xxhash64("Ticker", "Date"), F.lit(2)).cast("int"))


def close(a, b):
    assert set(a) == set(b)
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-9), k


def test_summaries_in_the_pass_equal_those_of_rows(spark, panel):
    table, cells = session.materialize(build_features(panel)), feature_cells(panel)
    moments = lambda rows: {r.f: (r.n, r.mean, r.m2, r.lo, r.hi) for r in Sel.column_moments(rows, NAMES).collect()}
    close(moments(cells), moments(table))
    plan = Sel.column_moments(cells, NAMES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2            # statistics, then fill and summary: features do not become rows
    products = Sel.column_products(cells, NAMES)
    ranges = Sel.product_ranges(products, NAMES)
    assert ranges == Sel.feature_ranges(table, NAMES)
    mi = lambda rows, **kw: {r.feature: r.mutual_info for r in Sel.binned_mutual_information(rows, NAMES, **kw).collect()}
    close(mi(cells, ranges=ranges), mi(table))
    pairs = lambda rows, **kw: {(r.i, r.j): r.correlation for r in Sel.correlated_pairs(rows, NAMES, **kw).collect()}
    close(pairs(None, parts=products), pairs(table))
    with pytest.raises(ValueError, match="NULL or NaN"):
        gap = table.withColumn("rsi", F.when(F.col("Ticker") == "A", F.col("rsi")))
        Sel.product_ranges(Sel.column_products(gap, ["macd", "rsi"]), ["macd", "rsi"])


def test_cells_before_and_after_scaling(panel):
    table = session.materialize(build_features(panel))
    stats = S.fit_scaler(table.where("split = 'train'"), NAMES)
    before = {c: f"before_{c}" for c in NAMES}
    both = S.apply_scaler(table.select(*NAMES, *[F.col(c).alias(b) for c, b in before.items()]), stats)
    rows = lambda df: {r.stage: (r.min, r.max, r.mean) for r in df.collect()}
    close(rows(S.scaled_cell_stats(feature_cells(panel), NAMES, stats)),
          rows(S.cell_stats_by_stage(both, {"before": list(before.values()), "after": NAMES})))


def test_nearest_neighbours_in_turns_and_ranges(spark, panel):
    some = ["rsi", "is_bull_market", "close_lag_1", "bb_position", "day_of_week"]
    n = panel.count()
    whole = {r.feature: r.mutual_info for r in Sel.knn_mutual_information(build_features(panel, only=some), some).collect()}
    asked, cells, written = [], feature_cells(panel), len(session._WRITTEN)

    def rows(columns, *more):
        asked.append(list(columns))
        return cells(columns, *more)

    for kw in ({"cells_at_once": 2 * n}, {"range_rows": 100, "chunk_rows": 30}, {"cells_at_once": n, "range_rows": 250}):
        asked.clear()
        got = Sel.knn_mutual_information(rows, some, labels=panel, sample=lambda share: feature_cells(panel), **kw)
        close({r.feature: r.mutual_info for r in got.collect()}, whole)
        turn = kw.get("cells_at_once", 5 * n) // n
        assert asked == [some[i:i + turn] for i in range(0, 5, turn)]     # only those of the turn are computed
        assert len(session._WRITTEN) == written                          # and nothing written for them stays
    bounds = Sel.range_bounds(lambda share: feature_cells(panel), some, n, range_rows=100)
    x = np.sort([r[0] for r in build_features(panel, only=["rsi"]).select("rsi").collect()])
    sizes = np.diff(np.searchsorted(x, [-1.0, *bounds[0], 101.0]))
    assert len(bounds[0]) == -(-n // 100) - 1 and sizes.max() <= 200
