"""Matching text to a fixed taxonomy. The taxonomy is a parameter: a small DataFrame or
list of (keyword, activity, category, ord), as read from a configuration file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pattern(words: list[str]) -> str:
    """A pattern of compiled code for the longest of some words that begins at a place: the words
    as a tree of their characters, so that a place is left at the first that doesn't fit."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def of(node: dict) -> str:
        ends = "" in node
        parts = [(c if c.isalnum() else f"\\{c}") + of(n) for c, n in sorted(node.items()) if c]
        if not parts:
            return ""
        if len(parts) == 1 and not ends:
            return parts[0]
        return f"(?:{'|'.join(parts)}){'?' if ends else ''}"

    return of(tree)


def match(df: DataFrame, text: str, keywords: list[tuple[str, str]]) -> DataFrame:
    """df with `activities`: distinct activities, in the keywords' order, whose keyword the
    lower-cased text contains.

    A text is read once, by one pattern for all keywords that finds the longest at each
    place; a keyword is there where one of these begins with it. An empty keyword is in
    every text.
    """
    none = F.array().cast("array<string>")
    if not keywords:
        return df.withColumn("activities", none)
    words = sorted({k for k, _ in keywords if k})
    always = [i for i, (k, _) in enumerate(keywords) if not k]
    # rules by the word that is found: those whose keyword it begins with
    rules = F.create_map(*(x for w in words for x in (F.lit(w), F.array(*(F.lit(i) for i, (k, _) in enumerate(keywords) if w.startswith(k))))))
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(f"(?=({_pattern(words)}))"), F.lit(1))) if words else none
    given = F.flatten(F.transform(found, lambda w: F.element_at(rules, w))) if words else F.array().cast("array<int>")
    order = F.array_sort(F.array_distinct(F.concat(given, F.array(*map(F.lit, always)).cast("array<int>"))))
    names = F.array(*(F.lit(a) for _, a in keywords))
    return df.withColumn("activities", F.array_distinct(F.transform(order, lambda i: F.element_at(names, i + 1))))


def assign(activity: Column, taxonomy: list[str], keywords: list[tuple[str, str]]) -> Column:
    """The activity itself where the taxonomy has it, else the first keyword's that it
    contains in the taxonomy's order, else null."""
    order = {a: i for i, a in enumerate(taxonomy)}
    rules = sorted(keywords, key=lambda p: order.get(p[1], len(order)))
    found = [F.when(F.lower(activity).contains(k), a) for k, a in rules]
    return F.coalesce(F.when(activity.isin(taxonomy), activity), *found)


def category_of(activity: Column, categories: dict[str, list[str]]) -> Column:
    """Category of an activity, any case; 'Unknown' where there is none."""
    rules = [F.when(F.lower(activity).isin([a.lower() for a in v]), c) for c, v in categories.items()]
    return F.coalesce(*rules, F.lit("Unknown"))


def reduce_to(df: DataFrame, items: str, taxonomy: list[str]) -> DataFrame:
    """items that the taxonomy has, repeats kept, with kept and removed counts."""
    inside = F.filter(items, lambda x: x.isin(taxonomy))
    out = df.withColumn("kept", inside).withColumn("n_kept", F.size(inside)).withColumn("n_removed", F.size(items) - F.size(inside))
    return out.withColumn(items, F.col("kept")).drop("kept")


def reduction_totals(df: DataFrame, items: str, taxonomy: list[str]) -> DataFrame:
    """One row: items kept and removed, rows that lose some, and kinds of items removed."""
    d = df.select(F.col(items).alias("i"), F.filter(items, lambda x: ~x.isin(taxonomy)).alias("gone"))
    kinds = d.select(F.explode("gone").alias("x")).agg(F.count_distinct("x").alias("removed_kinds"))
    n = d.agg(F.sum(F.size("i") - F.size("gone")).alias("kept"), F.sum(F.size("gone")).alias("removed"), F.count_if(F.size("gone") > 0).alias("modified"))
    return n.join(F.broadcast(kinds), F.lit(True))


def fallback(df: DataFrame, text: str, items: list[str], keywords: list[tuple[str, str]], categories: dict[str, list[str]]) -> DataFrame:
    """Activities and '<category> Services' from text, only where all of items are empty."""
    empty = F.lit(True)
    for c in items:
        empty = empty & (F.coalesce(F.size(c), F.lit(0)) <= 0)
    m = match(df, text, keywords).withColumn("activities", F.when(empty, F.col("activities")).otherwise(F.array().cast("array<string>")))
    of = lambda a: F.concat(category_of(a, categories), F.lit(" Services"))
    return m.withColumn("capabilities", F.array_distinct(F.transform("activities", of)))


def stages(activity: Column, rules: dict[str, list[str]]) -> Column:
    """Indexes of the stages that have a keyword within the activity, as an array."""
    low = F.lower(F.coalesce(activity, F.lit("")))
    hits = [F.when(low.rlike("|".join(ks)), F.lit(i)) for i, ks in enumerate(rules.values())]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


# Stages of a value chain in order, with their keywords.
VALUE_CHAIN = {
    "design": ["design", "eco-design", "circular design", "product development"],
    "production": ["manufacturing", "production", "fabrication", "assembly"],
    "distribution": ["logistics", "distribution", "transport", "delivery"],
    "use": ["retail", "rental", "leasing", "service", "maintenance", "repair"],
    "collection": ["collection", "take-back", "return", "gathering"],
    "recycling": ["recycling", "processing", "recovery", "remanufacturing"],
    "materials": ["raw material", "secondary material", "recycled material"],
}
