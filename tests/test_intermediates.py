"""The owner of intermediate tables removes them; a series table needs no exchange."""

import glob

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.session import intermediates, materialize, series_table, shared_folder


def test_owner_removes_what_was_written_inside(spark):
    folder = shared_folder(spark).removeprefix("file:")
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    outside = materialize(df)
    before = set(glob.glob(f"{folder}/*"))
    with intermediates(spark):
        t = series_table(df, ["k"], ["id"])
        out = t.withColumn("n", F.lag("id").over(Window.partitionBy("k").orderBy("id")))
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, t.collect())) == sorted(map(tuple, df.collect()))
        materialize(df)
        assert len(set(glob.glob(f"{folder}/*")) - before) == 2
        name = [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("tessera_")]
    assert set(glob.glob(f"{folder}/*")) == before and outside.count() == 100
    assert not set(name[-1:]) & {r.tableName for r in spark.sql("SHOW TABLES").collect()}
