"""Queries over relational operators: dedup, joins, merges, windows, aggregates, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text, urls
from ..operators import dedupe, hot, link, merge, setjoin, windows
from ..operators.scan import scan
from ..regions import REGIONS
from .base import query, read
from .expressions import _KM, _LAT, _LON, _SPLIT


@query("SELECT coalesce(c_mktsegment, 'Unknown') AS role, count(*) AS n FROM customer GROUP BY 1")
def role_distribution(spark, sf_dir):
    """Roles with their number of organisations; a missing role counts as Unknown."""
    return read(spark, sf_dir, "customer").groupBy(F.coalesce("c_mktsegment", F.lit("Unknown")).alias("role")).agg(F.count("*").alias("n"))


@query("SELECT nullif(source, 'src0') AS source, count(*) AS n FROM documents WHERE source <> 'src0' GROUP BY 1")
def value_counts_dropna(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.nullif(F.col("source"), F.lit("src0")).alias("source"))
    return d.where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT nullif(source, 'src0') AS source, count(*) AS n, count(nullif(lang, 'en')) AS n_lang FROM documents GROUP BY 1")
def value_counts_keepna(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.nullif(F.col("source"), F.lit("src0")).alias("source"), F.nullif(F.col("lang"), F.lit("en")).alias("lang"))
    return d.groupBy("source").agg(F.count("*").alias("n"), F.count("lang").alias("n_lang"))


@query("SELECT substr(c_name, 1, 16) AS area, count(*) AS n, (SELECT count(DISTINCT substr(c_name, 1, 16)) FROM customer) AS n_areas FROM customer GROUP BY 1 ORDER BY n DESC, area LIMIT 5")
def location_prefix_top5(spark, sf_dir):
    a = read(spark, sf_dir, "customer").groupBy(F.substring("c_name", 1, 16).alias("area")).agg(F.count("*").alias("n"))
    total = a.agg(F.count("*").alias("n_areas"))
    return a.orderBy(F.desc("n"), "area").limit(5).join(F.broadcast(total), F.lit(True))


_URLS = f"SELECT page_id, page_id % 3 AS src, CASE page_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END || page_id AS name, regexp_extract(url, {_SPLIT}, 2) AS url FROM pages"


def _sites(spark, sf_dir):
    k = F.col("page_id") % 3
    name = F.concat(F.when(k == 0, "a").when(k == 1, "b").otherwise("c"), F.col("page_id").cast("string"))
    return read(spark, sf_dir, "pages").select("page_id", k.alias("src"), name.alias("name"), urls.part(F.col("url"), 2).alias("url"))


@query(f"WITH p AS ({_URLS}), f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY src, page_id) AS n FROM p), l AS (SELECT url, max_by(name, src * 1000000 + page_id) AS name FROM p GROUP BY url) SELECT f.url, f.page_id, f.src, l.name FROM f JOIN l USING (url) WHERE n = 1")
def first_url_wins(spark, sf_dir):
    return dedupe.first_wins(_sites(spark, sf_dir), "url", ["src", "page_id"], "name").select("url", "page_id", "src", "name")


@query(f"WITH p AS ({_URLS}), f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY src, page_id) AS n FROM p) SELECT url, page_id, src, name FROM f WHERE n = 1")
def first_row_named(spark, sf_dir):
    return dedupe.first_row_named(_sites(spark, sf_dir), "url", ["src", "page_id"])


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def last_row_wins(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return dedupe.keep(e, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS site FROM events) SELECT user_id, event_id, site FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (site <> '') DESC, event_id) AS n FROM e) WHERE n = 1")
def prefer_nonempty(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("site"))
    return dedupe.prefer_filled(e, ["user_id"], "site", ["event_id"])


@query("SELECT user_id, event_type, value, place FROM (SELECT *, min(event_id) OVER (PARTITION BY user_id, event_type) AS place, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1")
def last_row_first_place(spark, sf_dir):
    return dedupe.last_row_first_place(read(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "value", "place")


@query("SELECT DISTINCT p_name, p_type, p_brand FROM part")
def full_row_distinct(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_name", "p_type", "p_brand").dropDuplicates()


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '2%' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')")
def without_earlier_branch(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return dedupe.without_earlier(o.where("o_orderpriority LIKE '2%'"), o.where("o_orderpriority LIKE '1%'"), ["o_custkey"]).select("o_orderkey")


@query("WITH i AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations) SELECT conv_id, list(turn ORDER BY turn) AS turns, list(role ORDER BY turn) AS roles FROM i WHERE n = 1 GROUP BY conv_id", lists=("turns", "roles"))
def distinct_structs(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("items"))
    d = c.select("conv_id", dedupe.distinct_structs(F.col("items"), "role").alias("items"))
    return d.select("conv_id", F.col("items.turn").alias("turns"), F.col("items.role").alias("roles"))


@query(f"""WITH p AS (SELECT page_id, page_id % 3 AS src, CASE WHEN page_id % 13 = 0 THEN '' ELSE regexp_extract(url, {_SPLIT}, 2) END AS u FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY src, page_id) AS k FROM p)
SELECT src, count(*) AS total, count(*) FILTER (u = '') AS no_url, count(*) FILTER (u <> '' AND k > 1) AS duplicate, count(*) FILTER (u <> '' AND k = 1) AS valid FROM n GROUP BY src""")
def ingest_stats(spark, sf_dir):
    from ..sources.registry import ingest_stats as stats

    p = read(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 3).alias("src"), F.when(F.col("page_id") % 13 == 0, "").otherwise(urls.part(F.col("url"), 2)).alias("u"))
    return stats(p, "u", "src", ["src", "page_id"])


@query(f"WITH p AS ({_URLS}), d AS (SELECT DISTINCT src, url FROM p) SELECT src, url, count(*) OVER (PARTITION BY src) AS n FROM d")
def category_urls(spark, sf_dir):
    return merge.grouped(_sites(spark, sf_dir), "src", "url")


@query("SELECT user_id AS url, '[' || string_agg(DISTINCT '\"' || event_type || '\"', ',' ORDER BY '\"' || event_type || '\"') || ']' AS categories, min_by(event_type, event_id) AS first_category FROM events GROUP BY 1")
def set_aggregation(spark, sf_dir):
    """Categories of a URL, of which there are as many as the taxonomy has."""
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("url")).agg(F.to_json(F.sort_array(F.collect_set("event_type"))).alias("categories"), F.min_by("event_type", "event_id").alias("first_category"))


@query("SELECT o_custkey AS doi, count(nullif(o_orderstatus, 'F')) AS n_authors, count(DISTINCT (nullif(o_orderpriority, '1-URGENT') IS NOT NULL)) AS institutions_total, count(DISTINCT nullif(o_orderpriority, '1-URGENT')) AS institutions, bool_or(o_totalprice > 200000) AS any_large, count(*) FILTER (o_totalprice > 200000) AS n_large FROM orders GROUP BY 1")
def doi_aggregate(spark, sf_dir):
    """institutions_total counts the distinct truth values of having one, as its users expect;
    institutions counts institutions."""
    o = read(spark, sf_dir, "orders")
    inst, big = F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")), F.col("o_totalprice") > 200000
    return o.groupBy(F.col("o_custkey").alias("doi")).agg(
        F.count(F.nullif(F.col("o_orderstatus"), F.lit("F"))).alias("n_authors"), F.count_distinct(inst.isNotNull()).alias("institutions_total"),
        F.count_distinct(inst).alias("institutions"), F.bool_or(big).alias("any_large"), F.count_if(big).alias("n_large"),
    )


@query("""WITH l AS (SELECT n_nationkey AS k, n_name AS v FROM nation WHERE n_nationkey < 20 UNION ALL SELECT n_nationkey, 'A ' || n_name FROM nation WHERE n_nationkey % 2 = 0 AND n_nationkey < 20), f AS (SELECT k, min(v) AS v FROM l GROUP BY k)
SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS homepage_before, CASE WHEN c_custkey % 3 = 0 THEN v ELSE c_mktsegment END AS homepage FROM customer LEFT JOIN f ON c_nationkey = k""")
def left_enrich_fill(spark, sf_dir):
    c = read(spark, sf_dir, "customer").withColumn("homepage", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")))
    n = read(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("homepage"))
    again = n.where("c_nationkey % 2 = 0").withColumn("homepage", F.concat(F.lit("A "), "homepage"))
    return merge.fill(c.withColumn("homepage_before", F.col("homepage")), n.unionByName(again), "c_nationkey", "homepage").select("c_custkey", "c_name", "homepage_before", "homepage")


@query("SELECT c_custkey, count(o_orderkey) AS n_orders, coalesce(bool_or(o_orderstatus = 'F'), false) AS any_f FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def aggregate_then_left(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_orderstatus") == "F").alias("f"))
    return read(spark, sf_dir, "customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("f", F.lit(False)).alias("any_f"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def anti_resume(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    o = read(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    return merge.resume(c, o, s, key="c_custkey").select("c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_metadata(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(o, "c_custkey", "left_semi").select("c_custkey", "c_name")


_ORGS = "SELECT c_custkey AS org_id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(c_name) || ' ' END AS org_name, 'https://Org' || (c_custkey % 700) || '.example.com/' AS org_url FROM customer"
_MENTIONS = "SELECT s_suppkey AS mention_id, CASE WHEN s_suppkey % 10 = 9 THEN ' ' ELSE replace(s_name, 'Supplier', 'Customer') END AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'https://org' || s_suppkey || '.example.com' ELSE 'https://none' || s_suppkey || '.example.com' END AS url FROM supplier"


def _orgs(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr("c_custkey AS org_id", "CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(c_name) || ' ' END AS org_name", "'https://Org' || (c_custkey % 700) || '.example.com/' AS org_url")


def _mentions(spark, sf_dir):
    return read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS mention_id", "CASE WHEN s_suppkey % 10 = 9 THEN ' ' ELSE replace(s_name, 'Supplier', 'Customer') END AS name", "CASE WHEN s_suppkey % 3 = 0 THEN 'https://org' || s_suppkey || '.example.com' ELSE 'https://none' || s_suppkey || '.example.com' END AS url")


@query(f"""WITH o AS ({_ORGS}), m AS ({_MENTIONS}), u AS (SELECT lower(rtrim(org_url, '/')) AS u, max(org_id) AS id FROM o GROUP BY 1), n AS (SELECT lower(trim(org_name)) AS k, max(org_id) AS id FROM o GROUP BY 1)
SELECT mention_id, coalesce(u.id, n.id) AS org_id, (CASE WHEN u.id IS NOT NULL THEN 0.95 WHEN n.id IS NOT NULL THEN 0.9 END)::DOUBLE AS confidence FROM m LEFT JOIN u ON lower(rtrim(m.url, '/')) = u.u LEFT JOIN n ON lower(trim(m.name)) = n.k WHERE trim(name) <> ''""")
def partner_link_exact(spark, sf_dir):
    return link.link_exact(_mentions(spark, sf_dir), _orgs(spark, sf_dir)).select("mention_id", "org_id", F.col("confidence").cast("double").alias("confidence"))


_FIRM = ("c_custkey AS org_id", "substr(md5(CAST(c_custkey AS {})), 1, 7) || ' ' || substr(md5(c_name), 3, CAST(6 + c_custkey % 9 AS int)) AS org_name")
_FIRMS = f"SELECT {_FIRM[0]}, {_FIRM[1].format('varchar')} FROM customer"
_CALLED = "CASE org_id % 4 WHEN 0 THEN substr(org_name, 1, 3) || substr(org_name, 5) WHEN 1 THEN upper(org_name) WHEN 2 THEN reverse(org_name) ELSE substr(org_name, 2) END AS name"


@query(f"""WITH o AS ({_FIRMS}), m AS (SELECT org_id AS mention_id, {_CALLED} FROM o WHERE org_id IN (SELECT s_suppkey FROM supplier)), n AS (SELECT lower(trim(org_name)) AS n, max(org_id) AS last, min(org_id) AS first FROM o GROUP BY 1),
x AS (SELECT mention_id, last FROM m JOIN n ON lower(trim(name)) = n), g AS (SELECT DISTINCT n, first, substr(n, 1, i - 1) || substr(n, i + 1) AS short FROM n, unnest(range(1, length(n) + 1)) t(i)),
f AS (SELECT mention_id, min(first) AS first, any_value(2.0 * length(short) / (2 * length(short) + 1)) AS r FROM m JOIN g ON lower(trim(name)) = short WHERE mention_id NOT IN (SELECT mention_id FROM x) GROUP BY 1)
SELECT mention_id, last AS org_id, 0.9::DOUBLE AS confidence, 'name' AS how FROM x UNION ALL SELECT mention_id, first, round(0.80 + (r - 0.85) * 0.33, 6)::DOUBLE, 'fuzzy' FROM f""")
def partner_link_fuzzy(spark, sf_dir):
    """Mentions that lack a letter, shout, read backwards; no other names come near."""
    o = read(spark, sf_dir, "customer").selectExpr(_FIRM[0], _FIRM[1].format("string"))
    m = o.join(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("org_id")), "org_id", "left_semi").selectExpr("org_id AS mention_id", _CALLED, "'' AS url")
    return link.link(m, o.withColumn("org_url", F.lit(""))).withColumn("confidence", F.round(F.col("confidence").cast("double"), 6))


# names like each other but for a letter, which makes their ratio n / (n + 1) with n letters in common
_LETTER = "substr('abcdefg', CAST(c_custkey % 7 + 1 AS int), 1)"
_NAME = f"CASE c_custkey % 4 WHEN 0 THEN 'Green Works GmbH' WHEN 1 THEN 'Blue Haus ' || {_LETTER} WHEN 2 THEN 'Alpha Recycling ' || {_LETTER} || ' e.V.' ELSE '' END AS name"
_URL = "'https://www.org' || (c_custkey {div} 40) || '.example.com/' || c_custkey AS url"
_ADDRESS = "'Street ' || (c_custkey % 3) || ' Town ' || (c_custkey % 5) || ' Hall ' || (c_custkey % 2) AS address"


def _people(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", _NAME, _URL.format(div="div"), _ADDRESS, "array('+49 40 ' || (c_custkey % 11)) AS phones")


# all pairs of a host, scored one by one
_PAIRS = f"""c AS (SELECT c_custkey AS id, {_NAME}, {_URL.format(div="//")}, {_ADDRESS}, '40' || (c_custkey % 11) AS phone FROM customer), x AS (SELECT id, regexp_extract(url, '://www.([^/]*)', 1) AS host, trim(replace(replace(lower(name), ' gmbh', ''), ' e.v.', '')) AS n, list_distinct(string_split(lower(address), ' ')) AS w, phone FROM c),
p AS (SELECT a.id AS i, b.id AS j, a.host, CASE WHEN a.n = b.n AND a.n <> '' THEN 1.0::DOUBLE WHEN a.n <> '' AND b.n <> '' AND a.n[:-2] = b.n[:-2] THEN (length(a.n) - 1)::DOUBLE / length(a.n) END AS ratio, len(list_intersect(a.w, b.w)) / least(len(a.w), len(b.w)) AS o, CASE WHEN a.phone = b.phone THEN a.phone END AS phone FROM x a JOIN x b ON a.host = b.host AND a.id < b.id),
q AS (SELECT *, CASE WHEN o >= 0.7 THEN o END AS overlap, 0.4::DOUBLE + coalesce(ratio * 0.3::DOUBLE, 0) + CASE WHEN o >= 0.7 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN phone IS NOT NULL THEN 0.1::DOUBLE ELSE 0 END AS score FROM p),
d AS (SELECT i, j, host, score, ratio, overlap, phone, list_filter(['domain_match:' || host, 'name_similarity:' || printf('%.2f', ratio), 'address_match:' || printf('%.2f', overlap), 'phone_match:' || phone], lambda s: s IS NOT NULL) AS signals FROM q WHERE score >= 0.7)"""


@query(f"WITH {_PAIRS} SELECT i, j, round(score, 6) AS score, signals FROM d", lists=("signals",))
def dedup_pairs(spark, sf_dir):
    """All pairs, those with the same name as well, which dedup_namesakes sums up."""
    d = link.duplicate_pairs(_people(spark, sf_dir), every=True)
    return d.select("i", "j", F.round("score", 6).alias("score"), link.signals(*map(F.col, ("host", "ratio", "overlap", "phone"))).alias("signals"))


@query(f"""WITH {_PAIRS}, e AS (SELECT d.*, x.n FROM d JOIN x ON d.i = x.id WHERE ratio = 1)
SELECT min(i) AS first, host, n AS name, count(*) AS n_pairs, count(overlap) AS n_address, count(phone) AS n_phone, count(*) FILTER (overlap IS NOT NULL AND phone IS NOT NULL) AS n_both, round(sum(score), 4) AS score, list_sort(list_distinct(flatten(list(signals)))) AS signals FROM e GROUP BY host, n""", lists=("signals",))
def dedup_namesakes(spark, sf_dir):
    return link.namesakes(_people(spark, sf_dir)).withColumn("score", F.round("score", 4)).drop("members")


@query(f"""WITH RECURSIVE {_PAIRS}, u AS (SELECT i AS a, j AS b FROM d UNION SELECT j, i FROM d), r AS (SELECT DISTINCT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a), g AS (SELECT node, min(seen) AS group_id FROM r GROUP BY node),
m AS (SELECT group_id, list(node ORDER BY node) AS members, max_by(name, length(name) * 10000000 - node) AS canonical_name FROM g JOIN c ON c.id = node GROUP BY 1),
t AS (SELECT group_id, avg(score) AS confidence, list_sort(list_distinct(flatten(list(signals)))) AS signals FROM d JOIN g ON d.i = g.node GROUP BY 1)
SELECT group_id, members, canonical_name, round(confidence, 6) AS confidence, signals FROM m JOIN t USING (group_id)""", lists=("members", "signals"))
def dedup_groups(spark, sf_dir):
    """Groups with the mean score of all their pairs and all that these share."""
    return link.duplicate_groups(_people(spark, sf_dir)).withColumn("confidence", F.round("confidence", 6))


_EDGES = "SELECT DISTINCT o_custkey AS source, l_suppkey AS target FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey <> l_suppkey"


def _marked(spark, sf_dir):
    """Edges with their opposite ones marked. Orders and their lines meet in tasks that have as many
    rows in a large table as in a small one."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("source"))
    l = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("target"))
    rows = l.count()
    met = hot.dealt(o, rows, "o_orderkey").join(hot.by_shuffle(hot.dealt(l, rows, "o_orderkey")), "o_orderkey")
    return link.distinct_edges(met.select("source", "target"), rows)


def _edges(spark, sf_dir):
    met = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return met.select(F.col("o_custkey").alias("source"), F.col("l_suppkey").alias("target")).where("source <> target").distinct()


@query(f"WITH e AS ({_EDGES}) SELECT e.source, e.target, f.source IS NOT NULL AS bidirectional FROM e LEFT JOIN e f ON f.source = e.target AND f.target = e.source")
def bidirectional_edges(spark, sf_dir):
    return _marked(spark, sf_dir)


@query("""WITH e AS (SELECT DISTINCT o_custkey AS a FROM orders WHERE o_custkey IS NOT NULL), i AS (SELECT a, a - row_number() OVER (ORDER BY a) AS g FROM e), c AS (SELECT a, min(a) OVER (PARTITION BY g) AS component FROM i)
SELECT a AS node, component FROM c UNION SELECT a + 1, component FROM c""")
def connected_groups(spark, sf_dir):
    """Customers linked to the next one where they have orders: runs of neighbours."""
    from ..operators.components import connected_components

    e = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), (F.col("o_custkey") + 1).alias("dst"))
    return connected_components(e)


@query("""WITH m AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 3 = 1 THEN c_custkey - 1 ELSE c_custkey END AS url FROM customer)
SELECT url, min(ord) AS ord FROM m WHERE url % 6 <> 0 GROUP BY url""")
def new_entities(spark, sf_dir):
    c = read(spark, sf_dir, "customer").selectExpr("c_custkey AS url", "c_custkey AS ord")
    canonical = c.where("ord % 3 = 1").selectExpr("url AS duplicate", "url - 1 AS canonical")
    return link.new_entities(c, c.where("ord % 6 = 0").select("url"), canonical, ["ord"]).select("url", "ord")


@query("SELECT c_custkey AS url, coalesce((SELECT min_by(o_orderpriority, o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'), 'Unknown') AS discovered_by FROM customer")
def discovery_first(spark, sf_dir):
    records = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").selectExpr("o_custkey AS url", "o_orderpriority AS by", "o_orderkey AS ord")
    return link.discoverer(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url")), records)


@query("SELECT c_custkey AS url, c_name AS by, o_orderkey AS found FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49) AND o_totalprice > 200000")
def discovery_records(spark, sf_dir):
    l = read(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    o = read(spark, sf_dir, "orders").where("o_totalprice > 200000").join(l, "o_orderkey", "left_semi")
    return o.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_custkey").alias("url"), F.col("c_name").alias("by"), F.col("o_orderkey").alias("found"))


@query("""WITH n AS (SELECT o_orderkey, o_custkey, o_totalprice, 'new' AS status FROM orders WHERE o_orderkey % 3 = 0), o AS (SELECT o_orderkey, o_custkey, o_totalprice - 1 AS o_totalprice, 'old' AS status FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_custkey, o.o_custkey) AS o_custkey, round(coalesce(n.o_totalprice, o.o_totalprice), 6) AS o_totalprice, coalesce(o.status, n.status) AS status FROM n FULL JOIN o ON n.o_orderkey = o.o_orderkey""")
def upsert_merge(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "o_custkey", "o_totalprice - 1 AS o_totalprice", "'old' AS status", "1 AS seq")
    new = o.where("o_orderkey % 3 = 0").selectExpr("o_orderkey", "o_custkey", "o_totalprice", "'new' AS status", "2 AS seq")
    return merge.upsert(old, new, ["o_orderkey"], "seq", frozen=["status"]).select("o_orderkey", "o_custkey", F.round("o_totalprice", 6).alias("o_totalprice"), "status")


@query("SELECT c_custkey AS url, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 0.5 END, CASE WHEN c_custkey % 2 = 0 THEN 1.5 END)::DOUBLE AS lat FROM customer")
def point_update(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    rows = c.selectExpr("c_custkey AS url", "CASE WHEN c_custkey % 2 = 0 THEN 1.5D END AS lat", "2.5D AS lon")
    points = c.where("c_custkey % 3 = 0").selectExpr("c_custkey AS url", "c_custkey * 0.5D AS lat", "9D AS lon")
    return merge.update_points(rows, points, "url").select("url", "lat")


_TRADE = """SELECT DISTINCT c.n_name AS source, s.n_name AS target FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation c ON c_nationkey = c.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey"""


@query(f"""WITH far AS (SELECT n_name FROM nation WHERE {_KM} > 30 OR n_name = 'NATION_12'), e AS ({_TRADE})
SELECT source, target FROM e WHERE source NOT IN (SELECT n_name FROM far) AND target NOT IN (SELECT n_name FROM far)""")
def geo_cascade_delete(spark, sf_dir):
    """Nations that trade, without those that are far or struck by hand."""
    r = REGIONS["hamburg"]
    n = read(spark, sf_dir, "nation").withColumns({"lat": F.expr(_LAT).cast("double"), "lon": F.expr(_LON).cast("double"), "name": F.col("n_name")})
    km = geo.haversine(F.lit(r.filter_at[0]), F.lit(r.filter_at[1]), F.col("lat"), F.col("lon"))
    names = merge.far_names(n, km, r.filter_km, ["NATION_12"])
    of = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_suppkey").distinct()
    of = of.join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    named = lambda key, out: n.select(F.col("n_nationkey").alias(key), F.col("name").alias(out))
    e = of.join(named("c_nationkey", "source"), "c_nationkey").join(named("s_nationkey", "target"), "s_nationkey").select("source", "target").distinct()
    return merge.remove_edges(e, names).select("source", "target")


@query("SELECT p_partkey, p_type, (row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1) // 60 AS batch FROM part")
def batch_ids(spark, sf_dir):
    return windows.batches(read(spark, sf_dir, "part").select("p_partkey", "p_type"), ["p_type"], ["p_partkey"], 60)


@query("SELECT conv_id, turn, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS role FROM conversations")
def lag_shift(spark, sf_dir):
    return windows.shifted(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "role", "conv_id", "turn")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM conversations""", ints=("run",))
def carry_forward(spark, sf_dir):
    c, head = read(spark, sf_dir, "conversations"), F.col("role") == "user"
    return scan(c, ["conv_id"], ["turn"], last={"section": F.when(head, F.col("text"))}, total={"run": head.cast("int")}).select("conv_id", "turn", "section", "run")


@query("""WITH w AS (SELECT conv_id, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS nx, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations),
h AS (SELECT conv_id, len(list_filter(regexp_extract_all(lower(nx), '[a-z0-9]+'), lambda t: length(t) >= 4 AND contains(lower(text), t))) > 0 AS hit FROM w WHERE nx IS NOT NULL AND n <= 40)
SELECT conv_id, count(*) FILTER (hit) AS hits, count(*) AS checked, count(*) FILTER (hit) >= greatest(5, floor(count(*) * 0.5)) AS misaligned FROM h GROUP BY conv_id""")
def lead_misalignment(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").withColumn("name", F.col("text"))
    return windows.misaligned(c, "name", "text", "conv_id", "turn")


@query("""WITH g AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations), k AS (SELECT *, min(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id, g) AS header_at FROM g WHERE g > 0)
SELECT conv_id, header_at, min_by(length(text), turn) FILTER (role = 'assistant' AND turn - header_at <= 5) AS n FROM k GROUP BY 1, 2""")
def look_ahead(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").withColumn("n", F.char_length("text").cast("bigint"))
    return windows.next_within(c, F.col("role") == "user", F.col("role") == "assistant", "n", "conv_id", "turn")


@query("SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS in_window FROM events")
def rate_window(spark, sf_dir):
    return windows.most_in(read(spark, sf_dir, "events"), "user_id", "ts", 3600).select("user_id", "event_id", "in_window")


@query("""WITH u AS (SELECT user_id, event_id, sum(1) OVER (PARTITION BY user_id ORDER BY event_id) AS used FROM events)
SELECT user_id, event_id, used, CASE WHEN used > 60 THEN 'over' WHEN used >= 54 THEN '90%' WHEN used >= 48 THEN '80%' ELSE 'ok' END AS level FROM u""", ints=("used",))
def quota_levels(spark, sf_dir):
    return windows.quota(read(spark, sf_dir, "events"), "user_id", F.lit(1), ["event_id"], 60.0).select("user_id", "event_id", "used", "level")


@query("""SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n <= 5""", ints=("l_linenumber",))
def topk_per_entity(spark, sf_dir):
    l = read(spark, sf_dir, "lineitem")
    return dedupe.keep(l, ["l_suppkey"], [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 5).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 3 WHEN '2' THEN 2 ELSE 1 END AS impact FROM orders ORDER BY impact DESC, o_totalprice DESC, o_orderkey LIMIT 100""", ints=("impact",))
def opportunity_sort(spark, sf_dir):
    k = F.substring("o_orderpriority", 1, 1)
    o = read(spark, sf_dir, "orders").withColumn("impact", F.when(k == "1", 3).when(k == "2", 2).otherwise(1))
    return o.orderBy(F.desc("impact"), F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "impact")


@query("""WITH r AS (SELECT user_id, event_id, (event_id * 7) % 41 AS prior, CASE WHEN event_id % 3 > 0 THEN (event_id * 13) % 50 END AS bonus FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prior DESC, event_id) AS n FROM r),
c AS (SELECT *, prior + coalesce(bonus, (SELECT arg_max(b.bonus, b.n) FROM n b WHERE b.user_id = n.user_id AND b.n < n.n AND b.bonus IS NOT NULL), 0) AS total FROM n WHERE n <= 5), t AS (SELECT *, min(CASE WHEN total >= 70 THEN n END) OVER (PARTITION BY user_id) AS stop FROM c)
SELECT user_id, event_id, total FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total DESC, n) AS k FROM t WHERE n <= coalesce(stop, 5)) WHERE k = 1""")
def early_exit_argmax(spark, sf_dir):
    e = read(spark, sf_dir, "events").selectExpr("user_id", "event_id", "(event_id * 7) % 41 AS prior", "CASE WHEN event_id % 3 > 0 THEN (event_id * 13) % 50 END AS bonus")
    return windows.early_exit(e, "user_id", "prior", "bonus", "event_id").select("user_id", "event_id", "total")


@query("SELECT c_custkey AS id, 'c' AS kind FROM customer UNION ALL SELECT s_suppkey, 's' FROM supplier")
def union_all(spark, sf_dir):
    return read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "'c' AS kind").unionByName(read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "'s' AS kind"), allowMissingColumns=True)


@query("SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def set_operations(spark, sf_dir):
    c, s, o = (read(spark, sf_dir, t) for t in ("customer", "supplier", "orders"))
    a, b = c.select(F.col("c_nationkey").alias("k")), s.select(F.col("s_nationkey").alias("k"))
    n = lambda op, df: df.agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "n")
    return n("union", a.union(b).distinct()).unionByName(n("intersect", a.intersect(b))).unionByName(n("except", c.select("c_custkey").subtract(o.select("o_custkey"))))


@query("""WITH d AS (SELECT lang, source, list_sort(list_distinct(list_filter(string_split(replace(lower(text), chr(10), ' '), ' '), lambda x: x <> ''))) AS w, min(doc_id) AS id, count(*) AS n FROM documents GROUP BY ALL)
SELECT a.id AS a, b.id AS b, round(len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)), 6) AS jaccard, a.n AS n_a, b.n AS n_b FROM d a JOIN d b ON a.lang = b.lang AND a.source = b.source AND a.id < b.id AND least(len(a.w), len(b.w)) >= 0.5 * greatest(len(a.w), len(b.w)) WHERE len(list_intersect(a.w, b.w)) / len(list_distinct(a.w || b.w)) >= 0.5""")
def jaccard_pairs(spark, sf_dir):
    """Pairs of different sets of words, named by their first documents, with their members."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.array_distinct(text.blank_words(F.col("text"))).alias("w"))
    return setjoin.similar_long_sets(d, "doc_id", "w", 0.5, ("lang", "source")).withColumn("jaccard", F.round("jaccard", 6))


@query("SELECT count(*) AS total, count(toxic) AS completed, count(*) FILTER (toxic = 1) AS failed, count(*) - count(toxic) AS remaining, round(100.0 * count(toxic) / count(*), 2)::DOUBLE AS percent, round(avg(toxic), 6) AS mean FROM documents LEFT JOIN labels USING (doc_id)")
def checkpoint_stats(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    n, done = F.count("*"), F.count("toxic")
    return d.agg(n.alias("total"), done.alias("completed"), F.count_if(F.col("toxic") == 1).alias("failed"), (n - done).alias("remaining"), F.when(n > 0, F.round(100.0 * done / n, 2)).otherwise(0.0).cast("double").alias("percent"), F.round(F.avg("toxic"), 6).alias("mean"))


@query("SELECT count(*) AS entries, count(c_acctbal) FILTER (c_acctbal > 0) AS hits FROM customer")
def cache_statistics(spark, sf_dir):
    return read(spark, sf_dir, "customer").agg(F.count("*").alias("entries"), F.count_if(F.col("c_acctbal") > 0).alias("hits"))


@query("SELECT user_id, event_id, site FROM (SELECT user_id, event_id, CASE WHEN value >= 5 THEN event_type END AS site, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN value >= 5 THEN event_type END NULLS LAST, event_id) AS n FROM events) WHERE n = 1")
def nulls_last_first(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", F.expr("CASE WHEN value >= 5 THEN event_type END").alias("site"))
    return dedupe.keep(e, ["user_id"], [F.asc_nulls_last("site"), "event_id"])


@query("SELECT user_id, kind, value FROM (SELECT user_id, lower(event_type) AS kind, value, row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY event_id) AS n FROM (SELECT user_id, event_id, value, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS event_type FROM events)) WHERE n = 1")
def folded_key_first(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "value", F.lower(F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type"))).alias("kind"))
    return dedupe.first_row_named(e, ["user_id", "kind"], ["event_id"]).select("user_id", "kind", "value")
