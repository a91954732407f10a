"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize, shared_folder

__all__ = ["WORD", "arrow_batches", "id_bucket", "materialize", "narrow", "shared_folder", "slices", "text_bytes", "uniform", "word_count"]

# Fixed value: a word is a run of anything but ASCII white space.  On UTF-8
# bytes, ``bytes.split()`` cuts at exactly these characters, and
# ``bytes.lower()`` lower-cases exactly A-Z.
WORD = r"[^\x20\x09-\x0D]+"


def narrow(df: DataFrame) -> DataFrame:
    """``materialize`` for a table of a few short columns."""
    return materialize(df, rebalance=True)


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (null: 0), evaluated in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*cols) -> Column:
    """A reproducible number in [0, 1) from the 53 low bits of a hash."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(float(1 << 53))


def id_bucket(ids: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: null)."""
    return F.crc32(ids.cast("string").cast("binary")) % F.lit(n)


def text_bytes(texts: Column) -> Column:
    """UTF-8 bytes of a text column (null: empty), passed to Python undecoded."""
    return F.coalesce(texts.cast("binary"), F.lit(b"").cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in smaller batches, so that what a task builds for one of
    them stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = 1000):
    """Jobs that run inside hand texts to Python in batches of ``rows``: with whole texts in
    them, Spark's default of 10,000 rows takes hundreds of MB beside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
