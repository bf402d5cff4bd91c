"""Distinct counts and frequent values that add up: sketches kept by group, united when read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct sketch, as a power of two; one standard error is 1.04 / 2**6.
REGISTERS = 12
#: Counters of a sketch of frequent values; a count is low by rows / counters at most.
COUNTERS = 1024


def summarise(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(*by, n, distinct, frequent): rows, a sketch of the distinct values, and a sketch of the
    frequent ones, for each group, say a source and a day. Null values are rows only."""
    frequent = F.expr(f"approx_top_k_accumulate(CAST(`{value}` AS string), {COUNTERS})")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.hll_sketch_agg(value, F.lit(REGISTERS)).alias("distinct"), frequent.alias("frequent"))


def united(sketches: DataFrame, by: list[str]) -> DataFrame:
    """summarise()'s rows of several runs, groups or days as one for each of by; what one pass
    over all their rows gives, within the same error."""
    frequent = F.expr(f"approx_top_k_combine(frequent, {COUNTERS})")
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("distinct").alias("distinct"), frequent.alias("frequent"))


def estimates(sketches: DataFrame, by: list[str], top: int = 10) -> DataFrame:
    """(*by, n, n_distinct, top): the estimated number of distinct values and the most frequent
    ones, as structs (item, count), of sketches."""
    return sketches.select(*by, "n", F.hll_sketch_estimate("distinct").alias("n_distinct"), F.expr(f"approx_top_k_estimate(frequent, {int(top)})").alias("top"))


def most_frequent(rows: DataFrame, found: DataFrame, by: list[str], value: str) -> DataFrame:
    """(*by, item, count): the most frequent value of each group, of ties the least, with its
    exact count. found is estimates() of the rows: a value with more than rows / COUNTERS rows is
    in the sketch, and of what the sketch tells the rows are counted again, as its counts are
    estimates once it had more values than counters.
    """
    told = found.select(*by, F.explode("top").alias("x")).select(*by, F.col("x.item").alias("item")).distinct()
    counted = rows.withColumn("item", F.col(value).cast("string")).join(F.broadcast(told), [*by, "item"]).groupBy(*by, "item").agg(F.count("*").alias("count"))
    first = F.struct((-F.col("count")).alias("n"), "item")
    return counted.groupBy(*by).agg(F.min(first).alias("m")).select(*by, F.col("m.item").alias("item"), (-F.col("m.n")).alias("count"))
