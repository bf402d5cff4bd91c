"""Groups that grow by batches: components with stable ids, and a log of what was merged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..scratch import written
from .components import connected_components
from .link import duplicate_pairs


def merge_edges(groups: DataFrame | None, edges: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """(groups, merged) after a batch of edges: groups (node, component), and merged (component,
    into) for the components of before that are part of another one now.

    A component's id is its least node, so it stays until a smaller node joins. Nodes of the
    batch stand for their components, and only the graph between those is searched; of the
    rest only labels that changed are looked up. Any split of the edges into batches gives
    the groups of one run. Null ends are ignored; groups is None at first.
    """
    e = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s IS NOT NULL AND d IS NOT NULL AND s <> d").distinct()
    if groups is None:
        new = written(connected_components(e, "s", "d"))
        return new, new.select("component", F.col("component").alias("into")).limit(0)
    ends = written(e)
    nodes = ends.select(F.explode(F.array("s", "d")).alias("node")).distinct()
    label = written(nodes.join(groups, "node", "left").select("node", F.coalesce("component", "node").alias("label"), F.col("component").isNull().alias("new")))
    of = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    between = ends.join(of("s"), "s").join(of("d"), "d")
    joined = written(connected_components(between, "s_label", "d_label"))
    changed = joined.where("node <> component")
    old = label.where("NOT new").select("label").distinct()
    merged = written(changed.join(old, F.col("node") == F.col("label")).select(F.col("node").alias("component"), F.col("component").alias("into")))
    kept = groups.join(merged, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    added = label.where("new").join(joined.select(F.col("node").alias("label"), "component"), "label", "left").select("node", F.coalesce("component", "label").alias("component"))
    return written(kept.unionByName(added)), merged


def duplicate_batch(known: DataFrame, batch: DataFrame, groups: DataFrame | None, least: float = 0.7) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, groups, merged) after a batch of orgs (id, name, url, address, phones) joins known
    ones: the pairs that score at least `least` and have an org of the batch, and what
    merge_edges() makes of them.

    Only known orgs at a host of the batch are compared, as a pair shares its host. Orgs with
    the same host and name are linked to the least of them.
    """
    host = urls.domain(F.col("url"), "strip")
    hosts = batch.select(host.alias("h")).where("h <> ''").distinct()
    old = known.withColumn("h", host).join(hosts, "h", "left_semi").drop("h")
    every = written(old.unionByName(batch))
    fresh = batch.select("id")
    pairs = duplicate_pairs(every, least)
    pairs = written(pairs.join(fresh.select(F.col("id").alias("i"), F.lit(True).alias("__i")), "i", "left").join(fresh.select(F.col("id").alias("j"), F.lit(True).alias("__j")), "j", "left").where("__i OR __j").drop("__i", "__j"))
    edges = pairs.select("i", "j")
    if least <= 0.4 + 0.3:
        from .link import _profiles

        p = _profiles(every).where("n <> ''").select("id", "host", "n")
        first = p.groupBy("host", "n").agg(F.min("id").alias("i"))
        edges = edges.unionByName(p.join(first, ["host", "n"]).where("id <> i").select("i", F.col("id").alias("j")))
    new, merged = merge_edges(groups, edges, "i", "j")
    return pairs, new, merged
