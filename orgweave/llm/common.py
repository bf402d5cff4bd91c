"""Shared helpers: reading tables, intermediate tables, text definitions, hot keys."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import forget, place, remove, unused, written

__all__ = ["LOWER", "SPACES", "UPPER", "ascii_lower", "fold", "forget", "hot_join", "let_go", "partitions", "place", "remove", "small_batches", "table", "unused", "written"]

#: White space of the word definition: blank, tab, newline, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key is hot where it has more than this share of the rows; fewer than its inverse can be.
HOT = 0.001


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle width that the cluster was configured with; the only sizing knob used."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let_go(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of past steps once their plans are collected."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Smaller Arrow batches for the jobs inside, so that workers that hold more than a batch
    stay small; the session's setting comes back after them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of doc_id as text, modulo k; null for a null doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % k


def hot_join(rows: DataFrame, of: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """rows joined to `of`, which has each key once and with n at least the rows that rows has
    of it, on key. Hot keys are joined by broadcast, so no task gets all rows of one: as their
    n add up to total at most, there are fewer than 1 / HOT of them. The others are shuffled.
    """
    hot = F.broadcast(of.where(F.col(n) > HOT * total))
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(of.where(F.col(n) <= HOT * total), key))
