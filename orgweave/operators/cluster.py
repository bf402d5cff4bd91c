"""Merging clusters of different batches by name, and rule-based clusters and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_words
from ..scratch import forget, written
from . import setjoin
from .dedupe import keep


def seeds(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(ord, seed): every node with the seed that takes it up; a seed takes itself.

    nodes: ord. links: pairs a < b of ords. In order, a node is a seed unless an earlier seed
    is linked to it, and goes to the earliest such seed. A round decides all nodes whose
    earlier neighbours are decided: those without an earlier open neighbour are seeds, and
    what is linked to them isn't. Rounds go by the longest chain of decisions.
    """
    links = written(links.select("a", "b").distinct())
    open_, followers, old = links, None, []
    while True:
        first = open_.select("a").distinct().join(open_.select(F.col("b").alias("a")), "a", "left_anti")
        got = written(open_.join(first, "a").select(F.col("b").alias("ord")).distinct())
        old.append(got)
        if got.isEmpty():
            break
        followers = got if followers is None else followers.unionByName(got)
        rest = open_.join(got.withColumnRenamed("ord", "b"), "b", "left_anti").join(got.withColumnRenamed("ord", "a"), "a", "left_anti")
        open_ = written(rest.join(first, "a", "left_anti").select("a", "b"))
        old.append(open_)
    if followers is None:
        return nodes.withColumn("seed", F.col("ord"))
    from_seeds = links.join(followers.withColumnRenamed("ord", "a"), "a", "left_anti")
    earliest = from_seeds.groupBy(F.col("b").alias("ord")).agg(F.min("a").alias("seed"))
    out = written(nodes.join(earliest, "ord", "left").withColumn("seed", F.coalesce("seed", "ord")))
    forget(links, *old)
    return out


def merge_clusters(clusters: DataFrame, threshold: float = 0.80) -> DataFrame:
    """Greedy merge in order of ord (unique), within a cluster_type: a seed takes up every
    later cluster, not yet taken, whose name has a Jaccard of threshold or more to its own.

    Clusters: cluster_type, ord, cluster_id, cluster_name, description, entities, items,
    confidence. A merged one keeps its seed's id and confidence; entities are a set, items
    are appended in order, the first of the longest names and its description win, and
    source_count counts. Names are compared as sets of words: equal ones follow the first
    of them, the others meet on rare words. Names without words stay alone.
    """
    c = clusters.withColumn("__w", F.array_distinct(blank_words(F.col("cluster_name"))))
    named = c.where(F.size("__w") > 0)
    of = setjoin.members(named, "ord", "__w", ("cluster_type",))
    links = setjoin.similar_sets(named, "ord", "__w", threshold, ("cluster_type",)).select("a", "b")
    heads = seeds(of.select(F.col("rep").alias("ord")).distinct(), links)
    seed = of.join(heads.withColumnRenamed("ord", "rep"), "rep").select(F.col("key").alias("ord"), "seed")
    met = c.join(seed, "ord", "left").withColumn("seed", F.coalesce("seed", "ord"))
    row = F.struct("ord", "cluster_id", "confidence", F.col("items").alias("i"))
    rows = F.sort_array(F.collect_list(row))
    longest = F.struct(F.char_length("cluster_name").alias("l"), (-F.col("ord")).alias("o"))
    out = met.groupBy("cluster_type", "seed").agg(
        rows.alias("r"), F.max_by(F.struct("cluster_name", "description"), longest).alias("n"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("entities")))).alias("entities"), F.count("*").cast("int").alias("source_count"),
    )
    first = F.get("r", F.lit(0))
    return out.select(
        "cluster_type", first["cluster_id"].alias("cluster_id"), "n.cluster_name", "n.description", "entities",
        F.flatten(F.transform("r", lambda x: x["i"])).alias("items"), first["confidence"].alias("confidence"), "source_count",
    )


def entities_of(clusters: DataFrame, cluster_id, order: str = "ord") -> DataFrame:
    """(entity) of the first cluster, by order, with the id; nothing where there is none."""
    first = clusters.where(F.col("cluster_id") == cluster_id).orderBy(order).limit(1)
    return first.select(F.explode("entities").alias("entity"))


def by_category(items: DataFrame, kind: str, category) -> DataFrame:
    """items (entity, item) clustered by category: the deterministic stand-in for a model."""
    named = items.withColumn("cluster_name", category)
    out = named.groupBy("cluster_name").agg(F.sort_array(F.collect_set("entity")).alias("entities"), F.sort_array(F.collect_list("item")).alias("items"))
    return out.select(F.concat_ws("_", F.lit(kind), F.lower("cluster_name")).alias("cluster_id"), "cluster_name", F.lit(kind).alias("cluster_type"), "entities", "items", F.lit(0.8).alias("confidence"))


def preview(items: Column, n: int = 5) -> Column:
    """First n items, and how many more there are."""
    more = F.size(items) - n
    head = F.array_join(F.slice(items, 1, n), ", ")
    return F.when(more > 0, F.concat(head, F.lit(", ... (+"), more.cast("string"), F.lit(" more)"))).otherwise(head)


def category_members(items: DataFrame, kind: str, category) -> DataFrame:
    """items (entity, item) as rows (cluster_id, cluster_name, entity, item) of by_category()'s
    clusters, for tables where a cluster is too large for one row."""
    named = items.select("entity", "item", category.alias("cluster_name"))
    return named.select(F.concat_ws("_", F.lit(kind), F.lower("cluster_name")).alias("cluster_id"), "cluster_name", "entity", "item")


def overview(members: DataFrame, n: int = 5) -> DataFrame:
    """(cluster_id, cluster_name, n_entities, n_items, preview) of category_members(): the first n
    items and how many more there are, as preview() says it, without a list of all.

    Entities are counted once; null entities and items not at all. A cluster whose items are
    all null has an empty preview. Counts are made before the shuffle, and of a cluster no
    task passes on more than n items.
    """
    at = ["cluster_id", "cluster_name"]
    once = members.groupBy(*at, "entity").agg(F.count("item").alias("k"))
    sums = once.groupBy(*at).agg(F.count("entity").alias("n_entities"), F.sum("k").alias("n_items"))
    few = keep(members.where("item IS NOT NULL").select(*at, "item"), at, ["item"], n)
    heads = few.groupBy(*at).agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("head"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"h.{c}")) for c in at]
    met = sums.alias("s").join(heads.alias("h"), same[0] & same[1], "left")
    more = F.when(F.col("n_items") > n, F.concat(F.lit(", ... (+"), (F.col("n_items") - n).cast("string"), F.lit(" more)"))).otherwise("")
    return met.select("s.cluster_id", "s.cluster_name", "n_entities", "n_items", F.concat(F.coalesce("head", F.lit("")), more).alias("preview"))


def gaps(needs: DataFrame, capabilities: DataFrame) -> DataFrame:
    """Need clusters without a word in common with any capability cluster."""
    word = lambda df: df.select("cluster_id", F.explode(F.array_distinct(blank_words(F.col("cluster_name")))).alias("word"))
    met = word(needs).join(word(capabilities).select("word").distinct(), "word").select("cluster_id").distinct()
    return needs.join(met, "cluster_id", "left_anti")


def rare_roles(profiles: DataFrame, least: int = 3) -> DataFrame:
    return profiles.groupBy(F.coalesce("role", F.lit("Unknown")).alias("role")).agg(F.count("*").alias("n")).where(F.col("n") < least)
