"""Ordered dedup. Every rule names its order; nothing relies on the order rows arrive in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep(df: DataFrame, keys: list, order: list, n: int = 1) -> DataFrame:
    """The first n rows of each key by order; null keys are a key like any other."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def first_wins(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """First row of each key, but named by the last row's name (names overwrite)."""
    at = F.struct(*order)
    last = df.groupBy(key).agg(F.max_by(name, at).alias("__name"))
    return keep(df, [key], order).drop(name).join(last, key).withColumnRenamed("__name", name)


def first_row_named(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """First row of each key with its own name."""
    return keep(df, [key] if isinstance(key, str) else key, order)


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return keep(df, [key], [F.desc(c) for c in order])


def prefer_filled(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """First row with a non-empty value, else the first row."""
    filled = F.coalesce(F.col(value), F.lit("")) != ""
    return keep(df, keys, [filled.desc(), *order])


def last_row_first_place(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row of each key, with `place`: the order value at which the key first came."""
    w = Window.partitionBy(*keys)
    return keep(df.withColumn("place", F.min(order).over(w)), keys, [F.desc(order)])


def without_earlier(df: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key an earlier branch has not given out yet."""
    return df.join(earlier.select(*keys).distinct(), keys, "left_anti")


def distinct_structs(items: Column, field: str) -> Column:
    """Structs of an array, the first of each field value, in order."""
    values = F.transform(items, lambda x: x[field])
    return F.filter(items, lambda x, i: F.array_position(values, x[field]) == i + 1)
