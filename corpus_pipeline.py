"""The corpus pipeline: STAGES in order, each written as Parquet and read again as the next one's ``docs``.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``; the last returns packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, packing, quality, simhash
from tessera.llm.common import shared_folder
from tessera.llm.queries import quality_labels
from tessera.sources.tables import read_table


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, hash of text) is in ``keys`` (doc_id, th)."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    wanted = keys.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"))
    return row.join(wanted, F.col("row.doc_id").eqNullSafe(F.col("_d"))
                    & F.xxhash64("row.text").eqNullSafe(F.col("_t")), "left_semi").select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    marked = docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("th")))
    judged = quality.judge_quality(marked, quality_labels(spark, sf_dir), key="doc_id.doc_id").where("kept")
    return keep_rows(docs, judged.select("doc_id.doc_id", "doc_id.th"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that later occurrences repeat."""
    return line_dedup.dedup_lines(docs, removed="_n_removed").drop("_n_removed")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near duplicates."""
    marked = docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("th")))
    groups = simhash.near_duplicates(marked, shingle=3, max_bits=3)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id.*").distinct()
    return one_of_each(keep_rows(docs, first))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One of the rows that are equal in doc_id and text."""
    row = docs.select("doc_id", F.xxhash64("text").alias("th"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return row.groupBy("doc_id", "th").agg(F.first("row").alias("row")).select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in a sequence."""
    pieces = packing.tokenize_pieces(docs)
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("quality rules", quality_stage), ("line dedup", line_stage), ("simhash near-dedup", near_duplicate_stage),
          ("mixing sources", mixing_stage), ("best-fit packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        out.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{i}")


# fingerprints, the forest, random rounding and the tokenizer have no SQL form;
# tests/llm compares the stages with brute force
ORACLE_SQL = None
