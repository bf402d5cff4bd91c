"""Record linkage: mentions to organisations, duplicates, links between clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..scratch import written
from . import fuzzy
from .components import connected_components
from .dedupe import keep
from .hot import by_shuffle, dealt


def link_exact(mentions: DataFrame, orgs: DataFrame) -> DataFrame:
    """Mentions (mention_id, name, url) linked to orgs (org_id, org_name, org_url).

    By normalised URL (0.95), else by trimmed lower-case name (0.90). Of several orgs with
    a key the one with the greatest org_id counts. Blank names are skipped. Two equi-joins,
    the second only over what the first left; both sides are deduplicated by key, so a
    frequent key meets one row; blank names and addresses of orgs go first.
    """
    m = mentions.where(F.trim(F.coalesce("name", F.lit(""))) != "")
    m = m.withColumn("u", urls.match_key(F.col("url"))).withColumn("k", F.lower(F.trim("name")))
    last = F.max("org_id")
    by_url = orgs.where(F.coalesce("org_url", F.lit("")) != "").groupBy(urls.match_key(F.col("org_url")).alias("u")).agg(last.alias("by_url"))
    by_name = orgs.where(F.trim(F.coalesce("org_name", F.lit(""))) != "").groupBy(F.lower(F.trim("org_name")).alias("k")).agg(last.alias("by_name"))
    one = m.join(by_url, "u", "left")
    two = one.join(by_name, "k", "left")
    how = F.when(F.col("by_url").isNotNull(), 0.95).when(F.col("by_name").isNotNull(), 0.90)
    return two.select("mention_id", "name", "k", F.coalesce("by_url", "by_name").alias("org_id"), how.alias("confidence"))


def link(mentions: DataFrame, orgs: DataFrame, least: float = 0.85) -> DataFrame:
    """(mention_id, org_id, confidence, how): at most one link a mention.

    What link_exact leaves is compared by sequence ratio, distinct names only: names meet
    on rare bigrams (see fuzzy.candidates, which loses no pair), and only what meets is
    scored, confidence 0.80 + (ratio - 0.85) * 0.33. Ties go to the least org_id.
    """
    exact = link_exact(mentions, orgs)
    rest = exact.where("org_id IS NULL").select("k").distinct()
    names = orgs.select(F.lower(F.trim("org_name")).alias("n"), "org_id").where("n <> ''").groupBy("n").agg(F.min("org_id").alias("fuzzy_id"))
    found = fuzzy.scored(fuzzy.candidates(rest, names.select("n"), least), least)
    best = keep(found.join(names, "n"), ["k"], [F.desc("ratio"), "fuzzy_id"]).select("k", "fuzzy_id", "ratio")
    met = exact.join(best, "k", "left")
    how = F.when(F.col("confidence") == 0.95, "url").when(F.col("confidence") == 0.90, "name").when(F.col("ratio").isNotNull(), "fuzzy")
    out = met.select("mention_id", F.coalesce("org_id", "fuzzy_id").alias("org_id"), F.coalesce("confidence", 0.80 + (F.col("ratio") - least) * 0.33).alias("confidence"), how.alias("how"))
    return out.where("org_id IS NOT NULL")


def _profiles(orgs: DataFrame) -> DataFrame:
    return orgs.select(
        "id", urls.domain(F.col("url"), "strip").alias("host"), text.legal_name(F.col("name")).alias("n"), F.array_distinct(text.blank_words(F.col("address"))).alias("w"),
        F.array_distinct(F.filter(F.transform(F.coalesce("phones", F.array().cast("array<string>")), text.phone), lambda p: p != "")).alias("p"),
    ).where("host <> ''")


def _two(x: Column) -> Column:
    return F.format_string("%.2f", x)


def _shared(p: Column, q: Column) -> Column:
    """The least phone number that two sets share."""
    return F.array_min(F.array_intersect(p, q))


def _rare_words(words: DataFrame, by: list[str]) -> DataFrame:
    """Of each set of words (by, size, word) the rarest: as many as may be missing from a larger
    set that has 0.7 of them, and one more."""
    ranked = words.join(by_shuffle(words.groupBy("word").agg(F.count("*").alias("df"))), "word").groupBy(*by, "size").agg(F.sort_array(F.collect_list(F.struct("df", "word"))).alias("o"))
    few = ranked.select(*by, "size", F.explode(F.slice("o", F.lit(1), (F.col("size") - F.ceil(F.col("size") * 0.7 - 1e-9) + 1).cast("int"))).alias("x"))
    return few.select(*by, "size", F.col("x.word").alias("word"))


def duplicate_pairs(orgs: DataFrame, least: float = 0.7, every: bool = False) -> DataFrame:
    """Pairs i < j of orgs (id, name, url, address, phones) that score at least `least`:
    (i, j, score, host, ratio, overlap, phone).

    Same host 0.4, name ratio of 0.85 or more times 0.3, address words overlapping by 0.7
    of the smaller set 0.2, a shared phone 0.1, summed in that order. ratio, overlap and phone
    (the least shared number) are null where they don't count. Above 0.6 a pair needs the
    host and two of the other three, or, up to 0.7, a like name alone. So pairs meet by host
    and like names with a phone or a rare address word, or by host, phone and a rare address
    word, never by host alone; names meet as distinct strings. Orgs with the same host and
    name are all alike up to 0.7: those pairs are left to namesakes(), which counts them, or
    listed with the others if every is true. At or below 0.6 the host isn't needed; that is
    refused.
    """
    if least <= 0.6:
        raise ValueError("thresholds up to 0.6 don't need a shared host and would compare all pairs")
    alike = least <= 0.4 + 0.3
    a = written(_profiles(orgs))
    names = a.where("n <> ''").select("host", "n").distinct()
    near = fuzzy.scored(fuzzy.candidates(names.withColumnRenamed("n", "k"), names, 0.85, ("host",)), 0.85)
    near = written(near.select("host", F.col("k").alias("n"), F.col("n").alias("n2"), "ratio").where("n <> n2" if alike else "true"))
    like = near.select("host", "n", "n2").unionByName(near.select("host", F.col("n2").alias("n"), F.col("n").alias("n2"))).distinct()

    phones = a.select("host", "n", "id", F.explode("p").alias("phone"))
    phones2 = phones.select("host", F.col("n").alias("n2"), F.col("id").alias("id2"), "phone")
    size = F.size("w")
    words = a.where(size >= 3).select("host", "n", "id", size.alias("size"), F.explode(F.transform("w", lambda x: F.xxhash64(x))).alias("word"))
    words2 = words.select("host", F.col("n").alias("n2"), F.col("id").alias("id2"), "word", F.col("size").alias("size2"))
    few = _rare_words(words, ["host", "n", "id"])

    met = [
        phones.join(by_shuffle(like), ["host", "n"]).join(by_shuffle(phones2), ["host", "n2", "phone"]),
        few.join(by_shuffle(like), ["host", "n"]).join(by_shuffle(words2), ["host", "n2", "word"]).where("size <= size2"),
        few.join(by_shuffle(phones.select("id", "phone")), "id").join(by_shuffle(words2.join(by_shuffle(phones2.select("id2", "phone")), "id2")), ["host", "phone", "word"]).where("size <= size2"),
    ]
    if alike:
        met[2] = met[2].where("n <> n2 OR n = ''")
    if least <= 0.4 + 0.3:
        met.append(a.select("host", "n", "id").join(by_shuffle(like), ["host", "n"]).join(by_shuffle(a.select("host", F.col("n").alias("n2"), F.col("id").alias("id2"))), ["host", "n2"]))
    if alike and every:
        named = a.where("n <> ''")
        met.append(named.select("host", "n", "id").join(by_shuffle(named.select("host", "n", F.col("id").alias("id2"))), ["host", "n"]))
    pairs = None
    for d in met:
        d = d.where("id <> id2").select(F.least("id", "id2").alias("i"), F.greatest("id", "id2").alias("j"))
        pairs = d if pairs is None else pairs.unionByName(d)
    one = a.select(F.col("id").alias("i"), "host", "n", "w", "p")
    two = a.select(F.col("id").alias("j"), F.col("n").alias("n2"), F.col("w").alias("w2"), F.col("p").alias("p2"))
    met = pairs.distinct().join(by_shuffle(one), "i").join(by_shuffle(two), "j").join(by_shuffle(near), ["host", "n", "n2"], "left")
    r = F.when((F.col("n") == F.col("n2")) & (F.col("n") != ""), 1.0).otherwise(F.col("ratio"))
    overlap = F.when((F.size("w") >= 3) & (F.size("w2") >= 3), text.overlap(F.col("w"), F.col("w2")))
    d = met.select("i", "j", "host", F.when(r >= 0.85, r).alias("ratio"), F.when(overlap >= 0.7, overlap).alias("overlap"), _shared(F.col("p"), F.col("p2")).alias("phone"))
    score = F.lit(0.4) + F.coalesce(F.col("ratio") * 0.3, F.lit(0.0)) + F.when(F.col("overlap").isNotNull(), 0.2).otherwise(0.0) + F.when(F.col("phone").isNotNull(), 0.1).otherwise(0.0)
    return d.select("i", "j", score.alias("score"), "host", "ratio", "overlap", "phone").where(F.col("score") >= least)


def signals(host: Column, ratio: Column, overlap: Column, phone: Column) -> Column:
    """What a pair shares, as texts."""
    parts = [F.concat(F.lit("domain_match:"), host), F.concat(F.lit("name_similarity:"), _two(ratio)), F.concat(F.lit("address_match:"), _two(overlap)), F.concat(F.lit("phone_match:"), phone)]
    given = [host, ratio, overlap, phone]
    return F.filter(F.array(*(F.when(g.isNotNull(), t) for g, t in zip(given, parts))), lambda x: x.isNotNull())


def namesakes(orgs: DataFrame) -> DataFrame:
    """All pairs of orgs with the same host and name, summed up by host and name:
    (first, host, name, members, n_pairs, n_address, n_phone, n_both, score, signals).

    first is the least id; score the sum of the pairs' scores, 0.7 each, 0.2 more for those
    with like addresses (n_address), 0.1 for those with a shared phone (n_phone); n_both
    have both. No pair is listed: equal sets of address words and of phones are classes with
    counts, and only different classes that share a rare word or a phone meet.
    """
    a = _profiles(orgs).where("n <> ''").select("id", "host", "n", F.sort_array("w").alias("w"), F.sort_array("p").alias("p"))
    at = ["host", "n"]
    groups = a.groupBy(*at).agg(F.count("*").alias("members"), F.min("id").alias("first")).where("members > 1")
    kinds = written(a.join(by_shuffle(groups.select(*at)), at, "left_semi").groupBy(*at, "w", "p").agg(F.count("*").alias("c")))
    half = lambda c: (c * (c - 1) / 2).cast("bigint")
    of = lambda d, *s: d.select(*at, *(F.col(c).alias(f"{c}2") for c in s))

    address = kinds.where(F.size("w") >= 3).groupBy(*at, "w").agg(F.sum("c").alias("c"))
    words = address.select(*at, "w", F.size("w").alias("size"), F.explode(F.transform("w", lambda x: F.xxhash64(x))).alias("word"))
    other = words.select(*at, F.col("w").alias("w2"), F.col("size").alias("size2"), "word")
    met = _rare_words(words, [*at, "w"]).join(by_shuffle(other), [*at, "word"]).where("w <> w2 AND size <= size2").select(*at, F.least("w", "w2").alias("w"), F.greatest("w", "w2").alias("w2")).distinct()
    near = written(met.withColumn("overlap", text.overlap(F.col("w"), F.col("w2"))).where("overlap >= 0.7"))
    by_address = near.join(by_shuffle(address), [*at, "w"]).join(by_shuffle(of(address, "w", "c")), [*at, "w2"]).select(*at, (F.col("c") * F.col("c2")).alias("k"), "overlap")
    by_address = by_address.unionByName(address.where("c > 1").select(*at, half(F.col("c")).alias("k"), F.lit(1.0).alias("overlap")))
    by_address = by_address.groupBy(*at).agg(F.sum("k").alias("n_address"), F.collect_set(F.concat(F.lit("address_match:"), _two(F.col("overlap")))).alias("s_address"))

    phone = kinds.where(F.size("p") > 0).groupBy(*at, "p").agg(F.sum("c").alias("c"))
    each = phone.select(*at, "p", F.explode("p").alias("phone"))
    met = each.join(by_shuffle(of(each, "p").withColumn("phone", F.explode("p2"))), [*at, "phone"]).where("p < p2").select(*at, "p", "p2").distinct()
    by_phone = met.join(by_shuffle(phone), [*at, "p"]).join(by_shuffle(of(phone, "p", "c")), [*at, "p2"]).select(*at, (F.col("c") * F.col("c2")).alias("k"), _shared(F.col("p"), F.col("p2")).alias("phone"))
    by_phone = by_phone.unionByName(phone.where("c > 1").select(*at, half(F.col("c")).alias("k"), F.array_min("p").alias("phone")))
    by_phone = by_phone.groupBy(*at).agg(F.sum("k").alias("n_phone"), F.collect_set(F.concat(F.lit("phone_match:"), F.col("phone"))).alias("s_phone"))

    full = kinds.where((F.size("w") >= 3) & (F.size("p") > 0))
    each = full.select(*at, "w", "p", "c", F.explode("p").alias("phone"))
    other = each.select(*at, F.col("w").alias("w2"), F.col("p").alias("p2"), F.col("c").alias("c2"), "phone")
    same = each.join(by_shuffle(other.withColumnRenamed("w2", "w")), [*at, "w", "phone"]).where("p < p2").select(*at, "w", F.col("w").alias("w2"), "p", "p2", "c", "c2")
    cross = each.join(by_shuffle(near.select(*at, "w", "w2")), [*at, "w"]).join(by_shuffle(other), [*at, "w2", "phone"]).select(*at, "w", "w2", "p", "p2", "c", "c2")
    both = same.unionByName(cross).distinct().select(*at, (F.col("c") * F.col("c2")).alias("k")).unionByName(full.where("c > 1").select(*at, half(F.col("c")).alias("k")))
    both = both.groupBy(*at).agg(F.sum("k").alias("n_both"))

    d = groups.join(by_shuffle(by_address), at, "left").join(by_shuffle(by_phone), at, "left").join(by_shuffle(both), at, "left")
    d = d.withColumn("n_pairs", half(F.col("members"))).fillna(0, ["n_address", "n_phone", "n_both"])
    none = F.array().cast("array<string>")
    told = F.sort_array(F.concat(F.array(F.concat(F.lit("domain_match:"), F.col("host")), F.lit("name_similarity:1.00")), F.coalesce("s_address", none), F.coalesce("s_phone", none)))
    score = (F.lit(0.4) + 0.3) * F.col("n_pairs") + 0.2 * F.col("n_address") + 0.1 * F.col("n_phone")
    return d.select("first", "host", F.col("n").alias("name"), "members", "n_pairs", "n_address", "n_phone", "n_both", score.alias("score"), told.alias("signals"))


def duplicate_groups(orgs: DataFrame, least: float = 0.7) -> DataFrame:
    """(group_id, members, canonical_name, confidence, signals) of the components of the pairs that
    score at least `least`.

    The longest name of a group is canonical, of equally long ones that of the least id;
    confidence is the mean score of all its pairs, namesakes included; signals has what any
    of them share, sorted. group_id is the least id.
    """
    pairs = written(duplicate_pairs(orgs, least))
    edges = pairs.select("i", "j")
    told = pairs.select("i", "score", F.lit(1).cast("bigint").alias("n"), signals(*map(F.col, ("host", "ratio", "overlap", "phone"))).alias("signals"))
    if least <= 0.4 + 0.3:
        same = written(namesakes(orgs))
        ids = _profiles(orgs).select("id", "host", F.col("n").alias("name")).join(by_shuffle(same.select("first", "host", "name")), ["host", "name"]).where("id <> first")
        edges = edges.unionByName(ids.select(F.col("first").alias("i"), F.col("id").alias("j")))
        told = told.unionByName(same.select(F.col("first").alias("i"), "score", F.col("n_pairs").alias("n"), "signals"))
    comp = connected_components(edges, "i", "j")
    met = told.join(by_shuffle(comp), F.col("i") == F.col("node"))
    score = met.groupBy("component").agg((F.sum("score") / F.sum("n")).alias("confidence"))
    every = met.select("component", F.explode("signals").alias("s")).distinct().groupBy("component").agg(F.sort_array(F.collect_list("s")).alias("signals"))
    named = comp.join(by_shuffle(orgs.select(F.col("id").alias("node"), "name")), "node")
    longest = F.struct(F.char_length(F.coalesce("name", F.lit(""))).alias("l"), (-F.col("node")).alias("n"))
    groups = named.groupBy("component").agg(F.sort_array(F.collect_list("node")).alias("members"), F.max_by("name", longest).alias("canonical_name"))
    return groups.join(by_shuffle(score), "component").join(by_shuffle(every), "component").withColumnRenamed("component", "group_id")


def mark_bidirectional(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """edges with bidirectional: whether the opposite edge exists."""
    back = edges.select(F.col(target).alias("__s"), F.col(source).alias("__t")).distinct().withColumn("__b", F.lit(True))
    met = edges.join(back, (F.col(source) == F.col("__s")) & (F.col(target) == F.col("__t")), "left")
    return met.withColumn("bidirectional", F.coalesce("__b", F.lit(False))).drop("__s", "__t", "__b")


def distinct_edges(edges: DataFrame, rows: int) -> DataFrame:
    """(source, target, bidirectional): edges, of about so many rows, once each, and whether the
    opposite one exists. Edges without an end, or from a node to itself, are left out.

    Both directions of a pair meet in one aggregation over its lesser and greater end; the
    edges aren't joined with themselves.
    """
    up = F.col("source") < F.col("target")
    way = edges.where("source <> target").select(F.least("source", "target").alias("lo"), F.greatest("source", "target").alias("hi"), F.when(up, 1).otherwise(2).alias("way"))
    pairs = dealt(way, rows, "lo", "hi").groupBy("lo", "hi").agg(F.bit_or("way").alias("ways"))
    d = pairs.withColumn("way", F.explode(F.when(F.col("ways") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array("ways"))))
    up = F.col("way") == 1
    return d.select(F.when(up, F.col("lo")).otherwise(F.col("hi")).alias("source"), F.when(up, F.col("hi")).otherwise(F.col("lo")).alias("target"), (F.col("ways") == 3).alias("bidirectional"))


def cluster_synergies(capabilities: DataFrame, needs: DataFrame) -> DataFrame:
    """Entities of capability clusters and need clusters that share a word.

    Both: cluster_id, cluster_name, entities, confidence. (source, target, confidence) with
    the least of both confidences; an entity isn't its own partner.
    """

    def words(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.col("cluster_id").alias(p + "id"), F.explode(F.array_distinct(text.blank_words(F.col("cluster_name")))).alias("word"))

    met = words(capabilities, "c").join(words(needs, "n"), "word").select("cid", "nid").distinct()
    c = capabilities.select(F.col("cluster_id").alias("cid"), F.explode("entities").alias("source"), F.col("confidence").alias("cc"))
    n = needs.select(F.col("cluster_id").alias("nid"), F.explode("entities").alias("target"), F.col("confidence").alias("nc"))
    out = met.join(c, "cid").join(n, "nid").where("source <> target")
    return out.groupBy("source", "target").agg(F.max(F.least("cc", "nc")).alias("confidence"))


def new_entities(found: DataFrame, existing: DataFrame, canonical: DataFrame, order: list) -> DataFrame:
    """Found (url, ...) mapped to canonical urls, those not existing, once each."""
    met = found.join(canonical.select(F.col("duplicate").alias("url"), "canonical"), "url", "left").withColumn("url", F.coalesce("canonical", "url")).drop("canonical")
    return keep(met.join(existing.select("url"), "url", "left_anti"), ["url"], order)


def discoverer(found: DataFrame, records: DataFrame) -> DataFrame:
    """found with the first that discovered each url, 'Unknown' where nobody did."""
    first = records.groupBy("url").agg(F.min_by("by", "ord").alias("discovered_by"))
    return found.join(first, "url", "left").withColumn("discovered_by", F.coalesce("discovered_by", F.lit("Unknown")))

