"""Partners of an organisation: complementary, along the value chain, nearby.

Each finder gives an entity's first partners, as many as asked for, and its scores are
found without listing all pairs: where scores tie, only the least entities of a word or of
a set of stages can be among the first, so those are found before anything is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_words
from ..scratch import forget, written
from . import setjoin
from .dedupe import keep
from .hot import join_counted
from .taxonomy import VALUE_CHAIN


def complementary(needs: DataFrame, offers: DataFrame, n: int = 5) -> DataFrame:
    """needs, offers: (entity, idx, item). (entity, partner, n_items, matched_items, score):
    the first n partners (by partner) of each entity with an offer that shares a word with
    its need, or the other way round; each pair of items scores 0.8, so does their mean.

    A partner beyond the n + 1 least entities of a shared word has n smaller ones before
    it, so only those of each word are candidates; items are matched for what is left.
    """

    def words(df: DataFrame) -> DataFrame:
        return df.select("entity", "idx", "item", F.array_distinct(blank_words(F.col("item"))).alias("w"))

    needs, offers = words(needs), words(offers)
    found = None
    for own, other in ((needs, offers), (offers, needs)):
        few = keep(other.select(F.col("entity").alias("partner"), F.explode("w").alias("word")).distinct(), ["word"], ["partner"], n + 1)
        met = own.select("entity", F.explode("w").alias("word")).distinct().join(few, "word").where("entity <> partner").select("entity", "partner")
        found = met if found is None else found.unionByName(met)
    pairs = keep(found.distinct(), ["entity"], ["partner"], n)

    def matched(own: DataFrame, other: DataFrame, way: int, label) -> DataFrame:
        b = other.select(F.col("entity").alias("partner"), F.col("idx").alias("idx2"), F.col("item").alias("item2"), F.col("w").alias("w2"))
        met = pairs.join(own, "entity").join(b, "partner").where(F.arrays_overlap("w", "w2"))
        return met.select("entity", "partner", F.struct(F.lit(way).alias("way"), "idx", "idx2", label.alias("label")).alias("m"))

    theirs = matched(needs, offers, 0, F.format_string("Their '%s' matches your need '%s'", "item2", "item"))
    own = matched(offers, needs, 1, F.format_string("Your '%s' matches their need '%s'", "item", "item2"))
    labels = F.transform(F.sort_array(F.collect_list("m")), lambda m: m["label"])
    return theirs.unionByName(own).groupBy("entity", "partner").agg(F.count("*").alias("n_items"), labels.alias("matched_items"), F.lit(0.8).alias("score"))


def chain_classes(stages: DataFrame) -> DataFrame:
    """stages: (entity, stage), stage from 0. (entity, stages): the set of an entity's stages
    as a mask; there are at most 2**stages - 1 of them, whatever the entities."""
    return stages.groupBy("entity").agg(F.bit_or(F.expr("shiftleft(1, stage)")).alias("stages"))


def chain_links(classes: DataFrame, names: tuple[str, ...] = tuple(VALUE_CHAIN)) -> DataFrame:
    """(stages, partner_stages, relation, matched_items): which sets of stages are partners.

    Stages one before are upstream, one after downstream, the same parallel; the relation is
    that of the highest pair of stages, own first.
    """
    at = F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.getbit("stages", i) == 1))
    own = classes.select("stages").distinct().select("stages", at.alias("own"))
    sent = own.select(F.col("stages").alias("partner_stages"), F.col("own").alias("other"), F.explode(F.array(F.col("own") - 1, "own", F.col("own") + 1)).alias("own"))
    label = F.array(*map(F.lit, names))
    a, b = F.element_at(label, F.col("own") + 1), F.try_element_at(label, F.col("other") + 1)
    kind = F.when(F.col("other") < F.col("own"), "upstream").when(F.col("other") > F.col("own"), "downstream").otherwise("parallel")
    said = F.when(F.col("other") < F.col("own"), F.concat(F.lit("Upstream: "), b, F.lit(" -> "), a)).when(F.col("other") > F.col("own"), F.concat(F.lit("Downstream: "), a, F.lit(" -> "), b)).otherwise(F.concat(F.lit("Same stage: "), a))
    met = own.join(sent, "own").select("stages", "partner_stages", F.struct("own", "other", kind.alias("kind"), said.alias("said")).alias("m"))
    all_m = F.sort_array(F.collect_list("m"))
    return met.groupBy("stages", "partner_stages").agg(F.max("m")["kind"].alias("relation"), F.transform(all_m, lambda m: m["said"]).alias("matched_items"))


def value_chain(stages: DataFrame, n: int = 3, names: tuple[str, ...] = tuple(VALUE_CHAIN)) -> DataFrame:
    """stages: (entity, stage). (entity, partner, relation, matched_items, score): the first n
    partners (by partner) one stage before, after, or at the same; all score 0.75.

    Entities with the same stages have the same partners but themselves, so the n + 1 least
    of each set of stages are all that is needed, and sets of stages are what is joined.
    """
    classes = chain_classes(stages)
    links = chain_links(classes, names)
    few = keep(classes.select(F.col("entity").alias("partner"), F.col("stages").alias("partner_stages")), ["partner_stages"], ["partner"], n + 1)
    first = keep(links.join(few, "partner_stages"), ["stages"], ["partner"], n + 1)
    met = classes.join(F.broadcast(first), "stages").where("entity <> partner")  # 2**stages * (n + 1) rows at most
    return keep(met, ["entity"], ["partner"], n).select("entity", "partner", "relation", "matched_items", F.lit(0.75).alias("score"))


def value_chain_counts(stages: DataFrame, names: tuple[str, ...] = tuple(VALUE_CHAIN)) -> DataFrame:
    """(entity, n_partners, n_upstream, n_downstream, n_parallel) over all partners, counted by
    sets of stages."""
    classes = chain_classes(stages)
    size = classes.groupBy(F.col("stages").alias("partner_stages")).agg(F.count("*").alias("n"))
    links = chain_links(classes, names).join(F.broadcast(size), "partner_stages")
    own = F.when(F.col("stages") == F.col("partner_stages"), F.col("n") - 1).otherwise(F.col("n"))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("relation") == k, own)), F.lit(0)).alias(f"n_{k}")
    sums = links.groupBy("stages").agg(F.sum(own).alias("n_partners"), of("upstream"), of("downstream"), of("parallel"))
    return classes.join(F.broadcast(sums), "stages").drop("stages")


def nearby(addresses: DataFrame, n: int = 3, share: float = 0.3, words: int = 2, levels: tuple[float, ...] = (0.8, 0.6, 0.45)) -> DataFrame:
    """addresses: (entity, address). (entity, partner, score): the first n partners, by score
    and then partner, whose addresses share at least `words` words that make at least
    `share` of the larger set's; that share is the score.

    Equal sets of words are one; a set's first partners are those of its members, so each
    set stands with its n + 1 least. Sets meet on their first two common words, the rarest
    (on one where one word is enough), at the highest level first: what has n partners there
    is done, and only the others go down to lower ones.
    """
    a = addresses.where(F.coalesce("address", F.lit("")) != "").select("entity", F.array_distinct(blank_words(F.col("address"))).alias("w"))
    reps = setjoin.classes(a, "entity", "w")
    of = setjoin.members(a.where(F.size("w") > 0), "entity", "w")
    ordered = setjoin.by_rarity(reps, "rep", "w", "n_members")
    sets = ordered.withColumnRenamed("n", "m")
    few = written(keep(of.withColumnRenamed("key", "partner"), ["rep"], ["partner"], n + 1))
    open_, found, held, both = sets.select("rep"), None, [], min(words, 2)
    for level in (*(x for x in levels if x > share), share):
        need = F.greatest(F.lit(words), F.ceil(F.col("m") * level - 1e-9))
        first = F.slice("o", F.lit(1), F.greatest(F.col("m") - need + both, F.lit(0)).cast("int"))
        p = sets.select("rep", "m", "n_members", F.inline(setjoin.keys_of(first, both)))
        one = p.join(open_, "rep").select(F.col("rep").alias("a"), F.col("m").alias("am"), F.col("pos").alias("ap"), "t", "u")
        two = p.select(F.col("rep").alias("b"), F.col("m").alias("bm"), F.col("pos").alias("bp"), "t", "u", "n_members")
        most = F.greatest("am", "bm")
        enough = F.greatest(F.lit(words), F.ceil(most * level - 1e-9))
        left = both + F.least(F.col("am") - F.col("ap") - 1, F.col("bm") - F.col("bp") - 1)
        met = one.join(two, ["t", "u"]).where((F.least("am", "bm") >= enough) & (left >= enough)).select("a", "b", "am", "bm", "n_members").distinct()
        met = met.join(sets.select(F.col("rep").alias("a"), F.col("o").alias("ao")), "a").join(sets.select(F.col("rep").alias("b"), F.col("o").alias("bo")), "b")
        common = F.size(F.array_intersect("ao", "bo"))
        met = met.withColumn("c", common).where(F.col("c") >= enough).withColumn("score", F.col("c") / most)
        # every class of a higher score, or of as high a one and a smaller least member, has a partner before
        got = written(keep(met.select("a", "b", "score", "n_members"), ["a"], [F.desc("score"), "b"], n + 1))
        held.append(got)
        full = got.groupBy(F.col("a").alias("rep")).agg(F.sum("n_members").alias("k")).where(F.col("k") > n).select("rep")
        done = got if level == share else got.join(full.withColumnRenamed("rep", "a"), "a", "left_semi")
        found = done if found is None else found.unionByName(done)
        if level != share:
            open_ = written(open_.join(full, "rep", "left_anti"))
            held.append(open_)
            if open_.isEmpty():
                break
    links = found.join(few.withColumnRenamed("rep", "b"), "b").select("a", "partner", "score")
    first = keep(links, ["a"], [F.desc("score"), "partner"], n + 1).withColumnRenamed("a", "rep")
    first = written(first.join(sets.select("rep", "n_members"), "rep"))
    met = join_counted(of, first, "rep", "n_members", of.count()).where("key <> partner")
    out = written(keep(met, ["key"], [F.desc("score"), "partner"], n).select(F.col("key").alias("entity"), "partner", "score"))
    forget(of, ordered, few, first, *held)
    return out


def opportunities(complement: DataFrame, chain: DataFrame, near: DataFrame) -> DataFrame:
    """(entity, partner, kind, score, impact, place): the 5, 3 and 3 best of each kind for every
    entity. Complementary partners have a high impact from 0.8 on, else a medium one, value
    chains a high and neighbours a medium one. place counts an entity's opportunities from 1
    by impact, score, kind in this order, and partner."""
    kinds = [("complementary", complement, 5), ("value_chain", chain, 3), ("geographic", near, 3)]
    out = None
    for k, (kind, df, n) in enumerate(kinds):
        d = keep(df.select("entity", "partner", "score"), ["entity"], [F.desc("score"), "partner"], n).withColumns({"kind": F.lit(kind), "k": F.lit(k)})
        out = d if out is None else out.unionByName(d)
    high = F.when(F.col("kind") == "complementary", F.col("score") >= 0.8).otherwise(F.col("kind") == "value_chain")
    out = out.withColumn("impact", F.when(high, "high").otherwise("medium"))
    return out.withColumn("place", F.expr("row_number() OVER (PARTITION BY entity ORDER BY impact, score DESC, k, partner)")).drop("k")
