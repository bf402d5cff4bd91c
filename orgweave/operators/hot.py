"""Joins on keys of which a few may hold much of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than this share of the rows; so there are fewer than its inverse.
HOT = 0.001
#: Rows that a task of dealt() is meant to have.
ROWS = 500_000


def join_counted(rows: DataFrame, of: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """rows joined to `of` on key; n of `of` is how often rows has the key, total counts rows.

    Hot keys are joined by broadcast, where the rows stand, so no task gets all of one; their
    n add up to total at most, which bounds them, and `of` may have a few rows of a key. All
    others are shuffled. Both sides are read more than once and should be written tables.
    """
    hot = F.col(n) > HOT * total
    often = F.broadcast(of.where(hot))
    rest = rows.join(F.broadcast(of.where(hot).select(key).distinct()), key, "left_anti").join(of.where(~hot), key)
    return rows.join(often, key).unionByName(rest)


def by_shuffle(df: DataFrame) -> DataFrame:
    """df for joins that are never made by broadcast. Many short rows are small as files and take
    ten times as much or more once the driver has put them into a table for all executors."""
    return df.hint("merge")


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by hash of keys over as many tasks as so many rows ask for, so that what a task sorts or
    sums up doesn't grow with the table, however few shuffle partitions are set."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, rows // ROWS + 1), *keys)
