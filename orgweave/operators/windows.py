"""Ordered-row operations: carrying headings forward, shifts, batches, look-ahead, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import unused, written
from .scan import scan


def carry_forward(value: Column, group: list, order: list) -> Column:
    """The last value that isn't null, up to the row; for groups that fit a task, see scan()."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def run_id(flag: Column, group: list, order: list) -> Column:
    """Number of flagged rows up to the row: the id of the group that a flag begins; for groups
    that fit a task, see scan()."""
    return F.sum(flag.cast("int")).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def numbered(df: DataFrame, group: list[str], order: list[str], number: str = "number") -> DataFrame:
    """df with the place of each row in its group, from 0, by order.

    Rows are dealt by ranges of (group, order), so a group of any size is spread; each range is
    numbered by itself, and the sizes of the ranges before it, a row for each range and
    group, give the offset.
    """
    by = [*group, *order]
    pid, at, n = unused(df, "range"), unused(df, "at"), unused(df, "n")
    rows = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    rows = written(rows.withColumn(pid, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()))
    sizes = rows.groupBy(*group, pid).agg(F.count("*").alias(n), F.min(at).alias("first"))
    before = F.coalesce(F.sum(n).over(Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("before", before).select(*(F.col(c).alias(f"__{i}") for i, c in enumerate(group)), F.col(pid).alias("__pid"), "first", "before")
    on = F.col(pid) == F.col("__pid")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"__{i}"))
    return rows.join(sizes, on).select(*df.columns, (F.col(at) - F.col("first") + F.col("before")).alias(number))


def batches(df: DataFrame, group: list[str], order: list[str], size: int, batch: str = "batch") -> DataFrame:
    """df with batches of `size` rows within a group, numbered from 0."""
    return numbered(df, group, order, batch).withColumn(batch, F.floor(F.col(batch) / size))


def misaligned(df: DataFrame, name: str, site: str, group: str, order: str, sample: int = 40) -> DataFrame:
    """Groups whose sites stand one row too early: in the first min(sample, rows - 1) rows a
    word of four letters and digits or more of the next row's name occurs in this row's site,
    in at least max(5, half) of them. (group, hits, checked, misaligned)"""
    rows = scan(df, [group], [order], total={"__n": F.lit(1)}, after={"__next": F.col(name)})
    words = F.filter(F.regexp_extract_all(F.lower(F.col("__next.v")), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.char_length(t) >= 4)
    rows = rows.where((F.col("__n") <= sample) & F.col("__next.v").isNotNull())
    hit = F.exists(words, lambda t: F.lower(F.coalesce(site, F.lit(""))).contains(t))
    sums = rows.groupBy(group).agg(F.count_if(hit).alias("hits"), F.count("*").alias("checked"))
    return sums.withColumn("misaligned", F.col("hits") >= F.greatest(F.lit(5), F.floor(F.col("checked") * 0.5)))


def shifted(df: DataFrame, column: str, group: str, order: str) -> DataFrame:
    """column of the row before, '' for the first."""
    d = scan(df, [group], [order], before={"__before": F.col(column)})
    return d.withColumn(column, F.when(F.col("__before").isNull(), "").otherwise(F.col("__before.v"))).drop("__before")


def next_within(df: DataFrame, header: Column, wanted: Column, value: str, group: str, order: str, ahead: int = 5) -> DataFrame:
    """For each header row the value of the first wanted row at most `ahead` rows on, before
    the next header. (group, header_at, value)"""
    d = scan(df, [group], [order], last={"header_at": F.when(header, F.col(order))}).where("header_at IS NOT NULL")
    ok = wanted & (F.col(order) - F.col("header_at") <= ahead)
    return d.groupBy(group, "header_at").agg(F.min_by(F.when(ok, F.col(value)), F.when(ok, F.col(order))).alias(value))


def most_in(df: DataFrame, key: str, at: str, seconds: int) -> DataFrame:
    """df with the number of the key's rows in the `seconds` up to each row; `at` is a timestamp."""
    frame = f"PARTITION BY {key} ORDER BY {at} RANGE BETWEEN INTERVAL {int(seconds)} SECOND PRECEDING AND CURRENT ROW"
    return df.withColumn("in_window", F.expr(f"count(*) OVER ({frame})"))


def quota(df: DataFrame, key: str, cost: Column, order: list, limit: float) -> DataFrame:
    """Running cost of a key and its level: ok, 80%, 90% or over."""
    level = F.when(F.col("used") > limit, "over").when(F.col("used") >= 0.9 * limit, "90%").when(F.col("used") >= 0.8 * limit, "80%").otherwise("ok")
    return scan(df, [key], order, total={"used": cost}).withColumn("level", level)


def early_exit(df: DataFrame, key: str, prior: str, bonus: str, order: str, top: int = 5, enough: float = 70) -> DataFrame:
    """The candidate chosen by going down the `top` highest priors of a key until a total has
    enough, else the first with the best total; with `total`.

    A total is prior and bonus. Where the bonus is null, as its page couldn't be fetched, that
    of the candidate before it still stands, 0 at the start.
    """
    w = Window.partitionBy(key).orderBy(F.desc(prior), order)
    d = df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= top)
    stands = F.last(bonus, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("total", F.col(prior) + F.coalesce(stands, F.lit(0)))
    stop = F.min(F.when(F.col("total") >= enough, F.col("__n"))).over(Window.partitionBy(key))
    d = d.withColumn("__s", F.coalesce(stop, F.lit(top))).where("__n <= __s").drop("__s")
    return d.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("total"), "__n"))).where("__r = 1").drop("__r", "__n")
