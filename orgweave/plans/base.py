"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def flat(df: DataFrame) -> DataFrame:
    """Arrays of plain values as text, parted by |, and int as bigint: the same in any engine."""
    kinds = dict(df.dtypes)
    joined = {c: F.array_join(F.transform(f"`{c}`", lambda x: x.cast("string")), "|") for c, t in kinds.items() if t.startswith("array<") and "struct" not in t}
    return df.withColumns(joined | {c: F.col(f"`{c}`").cast("bigint") for c, t in kinds.items() if t == "int"})


def query(sql: str | None = None, lists: tuple[str, ...] = (), ints: tuple[str, ...] = ()):
    """Register a function (spark, sf_dir) -> DataFrame under its name, its result flat().

    lists, ints: columns of the SQL that are lists, or integers of another width.
    """
    if lists or ints:
        casts = [f"array_to_string({c}, '|') AS {c}" for c in lists] + [f"{c}::BIGINT AS {c}" for c in ints]
        sql = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})"

    def add(f):
        QUERIES[f.__name__] = wraps(f)(lambda spark, sf_dir: flat(f(spark, sf_dir)))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
