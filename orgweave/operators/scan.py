"""Running values over lists of any length: two passes over ranges in place of one window.

Rows are dealt by ranges of (group, order), so one long list lies in many tasks. Each range
of a group is summed up in a row; what comes in from the ranges before it follows from those
rows alone, and is put in front of the range as one row more. Then each range runs by itself.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import unused, written


def scan(df: DataFrame, group: list[str], order: list, last: Mapping[str, Column] | None = None, total: Mapping[str, Column] | None = None, before: Mapping[str, Column] | None = None, after: Mapping[str, Column] | None = None) -> DataFrame:
    """df with columns over the rows of a group, by order.

    last: the last value that isn't null, up to the row; total: the sum up to the row, null
    before the first value; before, after: a struct with the value `v` of the row before or
    after, null where there is none. Null groups are groups. Of rows that are equal by order
    those with the smaller hash come first. An empty table gives an empty one; columns of
    the input called as outputs are replaced, others stay.
    """
    want = [(o, kind, c) for kind, of in (("last", last), ("total", total), ("before", before), ("after", after)) for o, c in (of or {}).items()]
    names = {o: unused(df, f"value{i}") for i, (o, _, _) in enumerate(want)}
    pid, at, place, tie = (unused(df, n) for n in ("range", "at", "place", "tie"))
    value = {o: F.struct(c.alias("v")) if kind in ("before", "after") else c for o, kind, c in want}
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumns({names[o]: v for o, v in value.items()} | {tie: F.xxhash64(*df.columns)})
    rows = rows.repartitionByRange(width, *group, *order, tie).sortWithinPartitions(*group, *order, tie).drop(tie)
    rows = written(rows.withColumn(pid, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id()))

    def summed(o: str, kind: str) -> Column:
        v = F.col(names[o])
        return {"last": F.max_by(v, F.when(v.isNotNull(), F.col(at))), "total": F.sum(v), "before": F.max_by(v, at), "after": F.min_by(v, at)}[kind].alias(names[o])

    by = Window.partitionBy(*group).orderBy(pid)
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)

    def carried(o: str, kind: str) -> Column:
        v = names[o]
        return {"last": F.last(v, ignorenulls=True).over(earlier), "total": F.sum(v).over(earlier), "before": F.lag(v).over(by), "after": F.lead(v).over(by)}[kind].alias(v)

    sums = rows.groupBy(*group, pid).agg(*(summed(o, kind) for o, kind, _ in want))
    carry = sums.select(*group, pid, *(carried(o, kind) for o, kind, _ in want))
    behind = {names[o] for o, kind, _ in want if kind == "after"}
    edge = lambda k, keep: carry.select(*group, pid, F.lit(k).alias(place), *(F.col(n) if (n in behind) == keep else F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names.values()))
    every = rows.withColumn(place, F.lit(1)).unionByName(edge(0, False), allowMissingColumns=True)
    if behind:
        every = every.unionByName(edge(2, True), allowMissingColumns=True)

    own = Window.partitionBy(*group, pid).orderBy(place, at)
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)

    def local(o: str, kind: str) -> Column:
        v = names[o]
        return {"last": F.last(v, ignorenulls=True).over(so_far), "total": F.sum(v).over(so_far), "before": F.lag(v).over(own), "after": F.lead(v).over(own)}[kind]

    out = every.withColumns({o: local(o, kind) for o, kind, _ in want}).where(F.col(place) == 1)
    return out.select(*[c for c in df.columns if c not in names], *names)
