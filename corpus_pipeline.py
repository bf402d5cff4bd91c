"""Corpus cleaning: five stages, each a DataFrame of what it keeps of the one before.

Toxic documents go, later lines go, one document of each near-duplicate group stays,
documents with benchmark passages go, and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgweave.llm import decontaminate, lines, pieces, simhash, toxicity
from orgweave.llm.common import place, remove, table, unused


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half, with their columns; null and empty
    texts stay or go alike, repeated rows too. An empty table stays one."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their later lines; n_chars follows. A document that had lines with
    words and loses them all goes; one that never had any, and null texts, stay as they
    are. Repeated rows are one document and stay alike; other columns stay."""
    columns, gone = docs.columns, unused(docs, "removed_lines")
    left = lines.without_lines(lines.mark(docs, out=gone), gone)
    word = r"[^\x20\x09-\x0D]"
    empty = (F.size(gone) > 0) & ~F.coalesce(F.col("text").rlike(word), F.lit(False))
    n = F.when(F.size(gone) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.where(~empty).withColumn("n_chars", n).select(columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the row with the group's least doc_id, of several such rows
    the one with the least text hash, and then the least hash of all columns; rows without
    an id come last. Null, empty and blank texts are a group like any other. The choice is
    made on hashes; texts are read once to make them and once to be given out."""
    every, text, tie = F.xxhash64(*docs.columns), F.xxhash64("text"), unused(docs, "row")
    grouped = simhash.near_duplicates(docs.withColumn(tie, every), keep=(tie,))
    best = grouped.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rk", F.col(tie).alias("row"))).alias("m"))
    i, k, r = unused(docs, "least_id"), unused(docs, "least_rk"), unused(docs, "least_row")
    best = best.select(F.col("m.doc_id").alias(i), F.col("m.rk").alias(k), F.col("m.row").alias(r))
    met = docs.join(best, F.col("doc_id").eqNullSafe(F.col(i)) & (text == F.col(k)) & (every == F.col(r)), "left_semi")
    return met.dropDuplicates()


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, with their columns. Null, empty and wordless texts
    have none and stay, as all do where the benchmark is empty; repeated rows stay or go alike."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the digest of the text's encoding, one row per row; null and empty texts have
    no ids. Texts may be of any length."""
    return pieces.digest(docs.select("doc_id", "text")).select("doc_id", "encoded.*")


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", no_benchmark),
    ("sentencepiece", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet in the shared folder, and
    goes when the next one is written, the last one when the session ends. Columns of
    documents with any names go through all stages but the last."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = place(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
