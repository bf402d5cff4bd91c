"""Large XML files: records cut out of byte ranges, and a census of tags over all of them.

Spark's text reader splits a file and reads lines that end where a record does, so a file of
any size is many tasks' work, and a record across two ranges is read once, by the range
that it begins in.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .markup import xml_records
from .registry import in_order

_ATTRIBUTES = """(?:[^<>"']|"[^"]*"|'[^']*')*"""
_TAG = rf"<([A-Za-z_][\w.:-]*)({_ATTRIBUTES})>"


def _no_comments(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)<!--.*?-->|<\?.*?\?>", "")


def xml_pieces(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(ord, xml): the records of a tag in the files at a path, in UTF-8. ord is the place: file,
    range, record and, for records without content that share a piece, their number.

    Records have no record of the same tag inside, and no end tag in a comment or a CDATA
    section; one that has is cut there and isn't well formed. Text outside of records,
    comments and processing instructions are passed over; a last record without an end too.
    """
    end, of = f"</{tag}>", re.escape(tag)
    lines = spark.read.option("lineSep", end).text(path)
    value, alone = _no_comments(F.col("value")), rf"<{of}(?=[\s/])(?:{_ATTRIBUTES})(?<=/)>"
    empty = F.regexp_extract_all(value, F.lit(f"({alone})"), F.lit(1))
    rest = F.regexp_extract(F.regexp_replace(value, alone, ""), rf"(?s)<{of}(?=[\s>]).*", 0)
    # the text behind a file's last record ends no record
    whole = F.when(rest != "", F.array(F.concat(rest, F.lit(end)))).otherwise(F.array().cast("array<string>"))
    d = lines.select(in_order(lines).alias("o"), F.posexplode(F.concat(empty, whole)).alias("k", "xml"))
    return d.select(F.struct("o.file", "o.block", "o.row", "k").alias("ord"), "xml")


def read_xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """(ord, xml, fields): records of a tag, flattened as markup.xml_records does; fields is null
    for what isn't well formed."""
    return xml_records(xml_pieces(spark, path, tag))


def tag_census(spark: SparkSession, path: str) -> DataFrame:
    """(tag, n, parents): how often each tag stands in the files at a path, and how often with an
    element inside.

    Files are read in pieces that end where an end tag begins. In a piece, all start tags but
    the last are followed by another one, so they have an element inside unless they end
    themselves; the last one has none.
    """
    pieces = spark.read.option("lineSep", "</").text(path).select(_no_comments(F.regexp_replace("value", r"(?s)<!\[CDATA\[.*?\]\]>", "")).alias("t"))
    tags, rest = F.regexp_extract_all("t", F.lit(_TAG), F.lit(1)), F.regexp_extract_all("t", F.lit(_TAG), F.lit(2))
    each = pieces.select(F.posexplode(F.arrays_zip(tags.alias("tag"), rest.alias("rest"))).alias("at", "x"), F.size(tags).alias("n"))
    inside = (F.col("at") < F.col("n") - 1) & ~F.col("x.rest").endswith("/")
    return each.groupBy(F.col("x.tag").alias("tag")).agg(F.count("*").alias("n"), F.count_if(inside).alias("parents"))


def record_tag(census: DataFrame) -> str | None:
    """The tag with elements inside that is most frequent so, the first by name of equals, if it
    comes at least five times and a tenth as often as the most frequent tag."""
    most = census.agg(F.max("n").alias("most"))
    r = census.where("parents > 0").crossJoin(F.broadcast(most)).orderBy(F.desc("parents"), "tag").first()  # one row on the right
    return r.tag if r is not None and r.parents >= max(5, r.most / 10) else None
