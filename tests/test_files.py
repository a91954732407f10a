import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import panel_df, panel_rows, random_walk
from tessera.operators import clean as C
from tessera.operators.features import build_features, feature_names
from tessera.operators.metrics import model_results
from tessera.operators.scaling import scaler_table
from tessera.sources import files as Fs


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def test_panel_csv_and_requests_round_trip(spark, folder):
    rows = [(dt.date(2020, 1, i), "A", 1.0, 2.0, 0.5, 1.5, 10.0, 0.0, 0.0) for i in range(1, 6)]
    spark.createDataFrame(rows, Fs.PANEL_SCHEMA).write.option("header", True).csv(f"{folder}/raw")
    back = Fs.read_panel_csv(spark, f"{folder}/raw")
    assert dict(back.dtypes)["Date"] == "date" and sorted(map(tuple, back.collect())) == rows
    spark.createDataFrame([("7", None), ("8", dt.date(2024, 1, 2))], Fs.REQUEST_SCHEMA) \
        .write.option("header", True).csv(f"{folder}/req")
    assert {tuple(r) for r in Fs.read_requests_csv(spark, f"{folder}/req").collect()} == {
        ("7", None), ("8", dt.date(2024, 1, 2))}


def test_bad_lines_go_to_quarantine(spark, folder):
    good = ["2020-01-01,A,1.0,2.0,0.5,1.5,10.0,0.0,0.0", "2020-01-02,A,,,,1.5,,,", "2020-01-03,\"B, C\",1,2,3,4,5,6,7"]
    bad = {"2020-13-45,A,1.0,2.0,0.5,1.5,10.0,0.0,0.0": ["Date"], "2020-01-04,A,1.0,x,0.5,y,10.0,0.0,0.0": ["High", "Close"],
           "2020-01-05,A,1.0": ["High", "Low", "Close", "Volume", "Dividends", "Stock Splits"],
           "2020-01-06,A,1,2,3,4,5,6,7,8": []}
    header = "Date,Ticker,Open,High,Low,Close,Volume,Dividends,Stock Splits"
    import os
    os.makedirs(f"{folder}/csv")
    for name, lines in (("a.csv", [*good, *bad]), ("b.csv", ["junk", *good[:1]]), ("c.csv", [])):
        with open(f"{folder}/csv/{name}", "w") as f:
            f.write("\n".join([header, *lines]) + "\n")
    rows, quarantine = Fs.read_panel_csv_tolerant(spark, f"{folder}/csv")
    assert rows.columns == header.split(",")
    want = sorted([("2020-01-01", "A", 1.5), ("2020-01-02", "A", 1.5), ("2020-01-03", "B, C", 4.0), ("2020-01-01", "A", 1.5)])
    assert sorted((str(r.Date), r.Ticker, r.Close) for r in rows.collect()) == want
    assert rows.count() == 4 and sorted(r.Close for r in rows.select("Close").collect()) == [1.5, 1.5, 1.5, 4.0]
    got = {(r.file, r.line): r.unread for r in quarantine.collect()}
    assert got.pop(("b.csv", "junk"))[0] == "Date"
    assert got == {("a.csv", line): unread for line, unread in bad.items()}
    assert quarantine.count() == 5 and quarantine.select("line").distinct().count() == 5
    counts = {(r.file, tuple(r.unread)): r.n for r in Fs.quarantine_counts(quarantine).collect()}
    assert counts[("a.csv", ("Date",))] == 1 and sum(counts.values()) == 5


def test_splits_and_features_round_trip(spark, folder):
    df = panel_df(spark, panel_rows("A", random_walk(70, 1))).withColumn("target", F.lit(1)) \
        .withColumn("split", F.when(F.dayofmonth("Date") < 20, "train").otherwise("test"))
    Fs.write_splits(df, f"{folder}/splits")
    back = spark.read.parquet(f"{folder}/splits")
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))
    feats = build_features(df)
    names = feature_names()
    Fs.write_features(feats, names, f"{folder}/feat")
    got = Fs.read_table_any(spark, f"{folder}/feat")
    kinds = dict(got.dtypes)
    assert kinds["year"] == "smallint" and kinds["month"] == kinds["target"] == "tinyint" and kinds["rsi"] == "float"
    a = feats.orderBy("Date").select("Date", "year", "month", "trend_direction", F.col("rsi").cast("float")).collect()
    b = got.orderBy("Date").select("Date", "year", "month", "trend_direction", "rsi").collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


def test_series_table_needs_no_exchange(spark, folder):
    from tessera.operators.sequences import sliding_sequences
    df = panel_df(spark, [r for i in range(6) for r in panel_rows(f"S{i}", random_walk(40, i))]) \
        .withColumn("target", F.lit(1)).withColumn("split", F.lit("train"))
    back = Fs.write_series(df, "handed_over", f"{folder}/series", buckets=4)
    again = Fs.write_series(df.where("Ticker <> 'S0'"), "handed_over", f"{folder}/series", buckets=4)
    assert again.count() == 200 and back.columns == df.columns
    seqs = sliding_sequences(again, ["Close", "Volume"], 10)
    plan = seqs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" in plan
    want = sliding_sequences(df.where("Ticker <> 'S0'"), ["Close", "Volume"], 10)
    assert sorted(map(str, seqs.collect())) == sorted(map(str, want.collect())) and seqs.count() > 0
    spark.sql("DROP TABLE handed_over")


def test_submission_files_are_sorted(spark, folder):
    sub = spark.createDataFrame([(str(i), i % 2) for i in range(500, 0, -1)], "ID string, Pred int")
    Fs.write_submission(sub, f"{folder}/sub")
    import glob
    ids = []
    for path in sorted(glob.glob(f"{folder}/sub/part-*")):
        with open(path) as f:
            assert next(f).strip() == "ID,Pred"
            ids += [line.split(",")[0] for line in f]
    assert ids == sorted(str(i) for i in range(1, 501))


def test_metadata_round_trip(spark, folder):
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(10)], "a double, b double")
    Fs.write_metadata(scaler_table(df, ["a", "b"]), f"{folder}/scaler")
    got = {r["feature"]: (r["mean"], r["scale"]) for r in Fs.read_metadata(spark, f"{folder}/scaler").collect()}
    assert got["a"] == pytest.approx((4.5, 8.25 ** .5))
    Fs.write_metadata(Fs.feature_list_table(spark, ["x", "y"]), f"{folder}/list")
    assert [r["feature"] for r in Fs.read_metadata(spark, f"{folder}/list").orderBy("position").collect()] == ["x", "y"]
    mi = spark.createDataFrame([("x", 0.1), ("y", 0.4), ("z", 0.1)], "feature string, mutual_info double")
    assert [(r["feature"], r["rank"]) for r in Fs.importance_table(mi).orderBy("rank").collect()] == [
        ("y", 1), ("x", 2), ("z", 3)]
    scores = spark.createDataFrame([(m, s, y, p) for m in ("m1", "m2") for s in ("train", "val") for y, p in
                                    ((0, .2), (1, .9 if m == "m1" else .3))], "model string, split string, Actual int, p double")
    table = Fs.comparison_table(model_results(scores)).collect()
    assert [(r["model"], r["val_accuracy"]) for r in table] == [("m1", 100.0), ("m2", 50.0)]


def test_sink_checks(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (2.5,)], "x double")
    assert [r["x"] for r in C.non_finite_to_zero(df, ["x"]).collect()] == [0.0, 0.0, 0.0, 2.5]
    with pytest.raises(KeyError):
        C.require_columns(df, ["x", "y"])
    assert C.require_columns(df, ["x", "y"], use_available=True) == ["x"]
    bad = spark.createDataFrame([(0,), (2,)], "Pred int")
    with pytest.raises(Exception, match="must be 0 or 1"):
        C.assert_binary(bad).collect()
