"""Synergies of organisations by the clusters they are in, without listing all pairs.

An organisation that offers what a cluster of capabilities has is a partner of one that is in
a cluster of needs, where the clusters' names share a word. Organisations in the same clusters
have the same partners but themselves: they are one class, and only classes are paired.

Members come as rows (cluster_id, entity), so no row holds a whole cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_words
from ..scratch import forget, written
from . import setjoin
from .dedupe import keep
from .hot import join_counted


def cluster_links(capabilities: DataFrame, needs: DataFrame) -> DataFrame:
    """Both: (cluster_id, cluster_name, confidence). (cid, nid, confidence) of the clusters whose
    names share a word, any case, with the least of both confidences; of several rows of a
    cluster the best counts. A null confidence leaves the other one, or none."""

    def words(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.col("cluster_id").alias(p + "id"), F.col("confidence").alias(p + "c"), F.explode(F.array_distinct(blank_words(F.col("cluster_name")))).alias("word"))

    met = words(capabilities, "c").join(words(needs, "n"), "word")
    return met.groupBy("cid", "nid").agg(F.max(F.least("cc", "nc")).alias("confidence"))


def _sets(members: DataFrame) -> DataFrame:
    """(entity, ids): the clusters an organisation is in, as many as it has."""
    return members.where("entity IS NOT NULL AND cluster_id IS NOT NULL").groupBy("entity").agg(F.sort_array(F.collect_set("cluster_id")).alias("ids"))


def class_links(capabilities: DataFrame, needs: DataFrame, offering: DataFrame, needing: DataFrame) -> DataFrame:
    """offering, needing: (cluster_id, entity). (source, target, confidence, n) between classes
    of organisations with the same clusters, each named by its least one: source offers what
    target, a class of n, needs. Confidence is that of the best pair of clusters."""
    own = setjoin.classes(_sets(offering), "entity", "ids").select(F.col("rep").alias("source"), F.explode("w").alias("cid"))
    other = setjoin.classes(_sets(needing), "entity", "ids").select(F.col("rep").alias("target"), F.col("n_members").alias("n"), F.explode("w").alias("nid"))
    sent = own.join(cluster_links(capabilities, needs), "cid").groupBy("source", "nid").agg(F.max("confidence").alias("confidence"))
    return sent.join(other, "nid").groupBy("source", "target").agg(F.max("confidence").alias("confidence"), F.max("n").alias("n"))


def synergy_counts(capabilities: DataFrame, needs: DataFrame, offering: DataFrame, needing: DataFrame) -> DataFrame:
    """(entity, n_partners, best): how many partners every organisation that has any has, itself
    not among them, and the confidence of the best. Counted by classes.

    An organisation is told by its class of offers and, as it isn't its own partner, by its
    class of needs; what such a pair of classes has is worked out once.
    """
    pairs = written(class_links(capabilities, needs, offering, needing))
    source = setjoin.members(_sets(offering), "entity", "ids")
    target = setjoin.members(_sets(needing), "entity", "ids")
    both = source.withColumnRenamed("rep", "source").join(target.withColumnRenamed("rep", "own"), "key", "left")
    name = F.to_json(F.struct("source", "own"), {"ignoreNullFields": "false"})
    each = written(both.withColumn("kind", name))
    kinds = each.groupBy("kind", "source", "own").agg(F.count("*").alias("size"))
    met = kinds.join(pairs, "source").withColumn("left", F.col("n") - F.when(F.col("own") == F.col("target"), 1).otherwise(0)).where("left > 0")
    sums = written(met.groupBy("kind", "size").agg(F.sum("left").alias("n_partners"), F.max("confidence").alias("best")))
    out = written(join_counted(each.select("kind", "key"), sums, "kind", "size", each.count()).select(F.col("key").alias("entity"), "n_partners", "best"))
    forget(pairs, source, target, each, sums)
    return out


def first_synergies(capabilities: DataFrame, needs: DataFrame, offering: DataFrame, needing: DataFrame, n: int = 5) -> DataFrame:
    """(entity, partner, confidence): the first n partners of each organisation, the surest
    first, of equally sure ones the least; it isn't its own.

    n + 1 classes and n + 1 members of each are enough: of a class that comes after n + 1
    others, each member comes after their least ones, of which one at most is the
    organisation itself.
    """
    pairs = written(class_links(capabilities, needs, offering, needing))
    source = setjoin.members(_sets(offering), "entity", "ids").withColumnRenamed("rep", "source")
    target = setjoin.members(_sets(needing), "entity", "ids").select(F.col("rep").alias("target"), F.col("key").alias("partner"))
    order = F.desc_nulls_last("confidence")
    few = keep(target, ["target"], ["partner"], n + 1)
    links = keep(pairs, ["source"], [order, "target"], n + 1).join(few, "target")
    first = keep(links, ["source"], [order, "partner"], n + 1).select("source", "partner", "confidence")
    sizes = source.groupBy("source").agg(F.count("*").alias("size"))
    first = written(first.join(sizes, "source"))
    met = join_counted(source, first, "source", "size", source.count()).where("key <> partner")
    out = written(keep(met, ["key"], [order, "partner"], n).select(F.col("key").alias("entity"), "partner", "confidence"))
    forget(pairs, first)
    return out
