"""The organisation graph: nodes, edges, insights, and what it lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import written


def nodes(profiles: DataFrame) -> DataFrame:
    """One node per profile (url, name, role, lat, lon, activities, description)."""
    return profiles.select(
        F.coalesce("name", F.lit("")).alias("id"), "url", F.coalesce("role", F.lit("Unknown")).alias("role"), "lat", "lon",
        F.coalesce("activities", F.array().cast("array<string>")).alias("activities"), F.coalesce("description", F.lit("")).alias("description"),
    )


def edges(relationships: DataFrame) -> DataFrame:
    return relationships.select("source", "target", "type", F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("evidence", F.lit("")).alias("evidence"), F.coalesce("bidirectional", F.lit(False)).alias("bidirectional"))


def insights_by_type(insights: DataFrame) -> DataFrame:
    """(section, title, insight): rows of the sections synergies, gaps and recommendations; the
    insight is JSON of the section's fields, entities for synergies only. One row an insight,
    so that nothing is collected; sort by section and title to write a document."""
    sections = {"synergy": ("synergies", ("title", "description", "entities", "confidence")), "gap": ("gaps", ("title", "description", "confidence", "priority")), "recommendation": ("recommendations", ("title", "description", "priority"))}
    kind = F.col("insight_type")
    section = F.coalesce(*(F.when(kind == k, s) for k, (s, _) in sections.items()))
    told = F.coalesce(*(F.when(kind == k, F.to_json(F.struct(*fields))) for k, (_, fields) in sections.items()))
    return insights.where(kind.isin(*sections)).select(section.alias("section"), "title", told.alias("insight"))


def coverage(profiles: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """Counts of profiles, located ones and ones at the fallback centre, and percentages."""
    from ..functions.geo import at_centre

    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    n = profiles.agg(F.count("*").alias("n"), F.count_if(located).alias("located"), F.count_if(at_centre(F.col("lat"), F.col("lon"), centre)).alias("at_centre"))
    return n.withColumn("percent", F.when(F.col("n") > 0, F.round(100.0 * F.col("located") / F.col("n"), 2)).otherwise(0.0))


def complete(json_rows: int, table_rows: int, share: float = 0.95) -> bool:
    """Whether a written graph has enough of its table; if not it is rebuilt."""
    return json_rows >= share * table_rows


def reconciled(document: DataFrame, table: DataFrame, share: float = 0.95) -> DataFrame:
    """(n_document, n_table, complete): whether a written graph has enough of its table's rows."""
    n = document.agg(F.count("*").alias("n_document"))
    m = table.agg(F.count("*").alias("n_table"))
    return n.join(F.broadcast(m), F.lit(True)).withColumn("complete", F.col("n_document") >= share * F.col("n_table"))


def reachable(edges: DataFrame, seeds: DataFrame, depth: int = 3) -> DataFrame:
    """(node, depth): nodes within `depth` steps of the seeds, by the shortest."""
    seen = seeds.select("node", F.lit(0).alias("depth")).distinct()
    front = seen
    for d in range(1, depth + 1):
        step = front.join(edges, front.node == edges.src).select(F.col("dst").alias("node")).distinct()
        front = written(step.join(seen, "node", "left_anti").withColumn("depth", F.lit(d)))
        seen = seen.unionByName(front)
    return seen


def discovery_paths(edges: DataFrame, seeds: DataFrame, depth: int = 3) -> DataFrame:
    """(node, depth, parent, chain): nodes within `depth` steps of the seeds by a shortest way;
    parent is the least of the nodes one step before, chain the ids from the seed on, parted
    by ' -> '. Seeds have no parent.

    A round for each step: nodes that were met before are out, which cuts cycles too, and of
    a node's parents the least is picked while they are summed up. Null ends are ignored.
    """
    name = F.col("node").cast("string")
    front = written(seeds.select("node").where("node IS NOT NULL").distinct().select("node", F.lit(0).alias("depth"), F.lit(None).cast(seeds.schema["node"].dataType).alias("parent"), name.alias("chain")))
    seen = front
    for d in range(1, depth + 1):
        step = front.select(F.col("node").alias("src"), "chain").join(edges.select("src", F.col("dst").alias("node")), "src").where("node IS NOT NULL")
        best = step.groupBy("node").agg(F.min(F.struct("src", "chain")).alias("p")).join(seen.select("node"), "node", "left_anti")
        front = written(best.select("node", F.lit(d).alias("depth"), F.col("p.src").alias("parent"), F.concat("p.chain", F.lit(" -> "), name).alias("chain")))
        seen = seen.unionByName(front)
    return seen
