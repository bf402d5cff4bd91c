"""Search queries as a product of small parameter tables (see search_terms)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def queries(terms: DataFrame, keywords: DataFrame, types: DataFrame, city: str | DataFrame) -> DataFrame:
    """(role, query, kind): '<term> <city>', '<keyword> <term> <city>' and '<type> <city>'.

    terms: (role, term); keywords: (keyword); types: (role, type). All are parameters of a few
    hundred rows, so the product is the size of the answer. city: one, or a table (city) of
    any size, whose rows each meet the broadcast parameters; the result has its column city.
    """
    broad = terms.select("role", F.col("term").alias("what"), F.lit("broad").alias("kind"))
    fine = terms.crossJoin(keywords).select("role", F.concat_ws(" ", "keyword", "term").alias("what"), F.lit("specific").alias("kind"))
    every = broad.unionByName(fine).unionByName(types.select("role", F.col("type").alias("what"), F.lit("type").alias("kind")))
    if isinstance(city, str):
        return every.select("role", F.concat_ws(" ", "what", F.lit(city)).alias("query"), "kind")
    return city.select("city").crossJoin(F.broadcast(every)).select("city", "role", F.concat_ws(" ", "what", "city").alias("query"), "kind")


def costs(queries: DataFrame, each: float = 0.032, eur: float = 0.92) -> DataFrame:
    n = F.count("*")
    return queries.agg(n.alias("n"), F.round(n * each, 6).alias("usd"), F.round(n * each * eur, 6).alias("eur"))
