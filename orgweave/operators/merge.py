"""Upserts, point updates and cascades as relations: old table in, new table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str, frozen: list[str] = ()) -> DataFrame:
    """Rows of both by key, the last by order wins; new beats old. frozen: columns whose
    first value, the old one if there is one, stays."""
    both = old.withColumn("__b", F.lit(0)).unionByName(new.withColumn("__b", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("__b"), F.desc(order))
    first = Window.partitionBy(*keys).orderBy("__b", order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = both.withColumns({c: F.first(c).over(first) for c in frozen})
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__b")


def update_points(rows: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """lat and lon by key from points where they have them."""
    p = points.select(key, F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    met = rows.join(p, key, "left")
    return met.withColumn("lat", F.coalesce("__lat", "lat")).withColumn("lon", F.coalesce("__lon", "lon")).drop("__lat", "__lon")


def fill(rows: DataFrame, lookup: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """value from the lookup where a row has none (null or ''). Of several lookup rows with a
    key the first counts, by order, else by value; rows are never multiplied."""
    first = F.min_by(value, order) if order else F.min(value)
    met = rows.join(lookup.groupBy(key).agg(first.alias("__v")), key, "left")
    return met.withColumn(value, F.coalesce(F.nullif(F.col(value), F.lit("")), "__v")).drop("__v")


def grouped(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, n): the distinct values of each key, a row each, and how many it has. A
    document of lists by key is written from these rows in order."""
    d = rows.select(key, value).distinct()
    n = d.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("n"))
    return d.join(n, F.col(key).eqNullSafe(F.col("__k"))).select(key, value, "n")


def remove_entities(entities: DataFrame, names: DataFrame) -> DataFrame:
    """Entities whose name isn't in names(name); null names stay."""
    return entities.join(names.select("name").distinct(), "name", "left_anti")


def remove_edges(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges that touch no removed name at either end."""
    n = names.select("name").distinct()
    return edges.join(n, edges.source == n.name, "left_anti").join(n, F.col("target") == n.name, "left_anti")


def far_names(entities: DataFrame, km, limit: float, manual: list[str] = ()) -> DataFrame:
    """Names to drop: those of an entity beyond the limit, and manual ones. A null distance
    is 0. Namesakes of a far entity go with it."""
    far = F.coalesce(km, F.lit(0.0)) > limit
    return entities.where(far | F.col("name").isin(list(manual))).select("name").distinct()


def resume(todo: DataFrame, *done: DataFrame, key: str = "url") -> DataFrame:
    """What no earlier run has done."""
    for d in done:
        todo = todo.join(d.select(key).distinct(), key, "left_anti")
    return todo


def contract(df: DataFrame, schema) -> DataFrame:
    """Columns of schema in its order and types; absent ones null, text null as '' and
    numbers null as 0, but for nullable coordinates (lat, lon)."""
    out = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        kind = f.dataType.typeName()
        if kind == "string":
            c = F.coalesce(c, F.lit(""))
        elif kind in ("double", "float", "integer", "long") and f.name not in ("lat", "lon"):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)
