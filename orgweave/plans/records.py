"""Queries over the operators of organisations' rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe, profiles
from ..regions import REGIONS
from ..sources import markup, office
from .base import query, read
from .expressions import _SPLIT


_AT = "TIMESTAMP '2024-01-02 03:04:05'"


@query(f"""SELECT c_name AS name, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'near ' || c_nationkey) AS address, coalesce(CASE WHEN c_custkey % 5 = 0 THEN '+49 ' || c_custkey END, '') AS phone, 'https://c' || c_custkey AS website,
(53.5 + c_nationkey)::VARCHAR AS latitude, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE (10.25 + c_nationkey)::VARCHAR END AS longitude, 'p' || c_custkey AS google_place_id, CASE WHEN c_custkey % 3 = 0 THEN 'bank' ELSE 'school, ' || lower(c_mktsegment) END AS place_types, 'OPERATIONAL' AS business_status,
(c_custkey % 5 + 0.5)::VARCHAR AS rating, c_custkey::VARCHAR AS user_ratings_total, c_mktsegment AS ecosystem_role, 'q ' || c_nationkey AS search_query, strftime({_AT}, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM customer""")
def place_rows(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    fields = [
        "'name', c_name", "'formatted_address', CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END", "'vicinity', 'near ' || c_nationkey", "'formatted_phone_number', CASE WHEN c_custkey % 5 = 0 THEN '+49 ' || c_custkey END", "'website', 'https://c' || c_custkey",
        "'geometry', named_struct('location', named_struct('lat', CAST(53.5 + c_nationkey AS double), 'lng', CAST(CASE WHEN c_custkey % 7 <> 0 THEN 10.25 + c_nationkey END AS double)))", "'place_id', 'p' || c_custkey",
        "'types', CASE WHEN c_custkey % 3 <> 0 THEN array('school', lower(c_mktsegment)) END", "'type', 'bank'", "'business_status', 'OPERATIONAL'", "'rating', CAST(c_custkey % 5 + 0.5 AS double)", "'user_ratings_total', c_custkey",
    ]
    p = F.expr(f"named_struct({', '.join(fields)})")
    return c.withColumn("p", p).select(*profiles.place_row(F.col("p"), F.col("c_mktsegment"), F.expr("'q ' || c_nationkey"), F.expr(_AT)))


_SITE = "CASE c_custkey % 5 WHEN 0 THEN ' https://www.Koeln.de/ ' WHEN 1 THEN NULL WHEN 2 THEN 'https://www.koeln.de' WHEN 3 THEN 'n/a' ELSE c_name END"


@query(f"SELECT c_custkey, CASE WHEN lower(trim({_SITE})) = 'https://www.koeln.de/' THEN '' ELSE {_SITE} END AS website FROM customer")
def placeholder_blanking(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", profiles.blank_placeholders(F.expr(_SITE)).alias("website"))


_AFFILIATED = "CASE doc_id % 6 WHEN 0 THEN 'DESY' WHEN 1 THEN 'Max-Planck-Institut, HAMBURG' WHEN 2 THEN 'Hamburger Hof' WHEN 3 THEN text || ' Hamburg-Harburg' WHEN 4 THEN text END"


@query(rf"SELECT doc_id, trim(coalesce({_AFFILIATED} || ' ', '') || lang) <> '' AND regexp_matches(lower(coalesce({_AFFILIATED} || ' ', '') || lang), '{'|'.join(f'(?:{p})' for p in profiles.AFFILIATION)}') AS related FROM documents")
def affiliation_patterns(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", profiles.mentions([F.expr(_AFFILIATED), F.col("lang")], profiles.AFFILIATION).alias("related"))


_PAGE = "CASE doc_id % 4 WHEN 0 THEN '20539 Hamburg, 040 1: solar, waste, repair ' || text WHEN 1 THEN 'solar, waste, repair ' || text WHEN 2 THEN 'Altona ' || text ELSE text END"
_WORDS = ["solar", "waste", "repair", "eco-", "thea", "über"]


@query(rf"""WITH p AS (SELECT doc_id, lower({_PAGE}) AS t FROM documents), s AS (SELECT doc_id, (regexp_matches(t, '\b2[0-2][0-9]{{3}}\b')::INT + ({' OR '.join(f"contains(t, '{n}')" for n in REGIONS['hamburg'].names)})::INT + regexp_matches(t, '\+49 40|\b040\b')::INT) / 3.0 AS place, ({' + '.join(f"contains(t, '{w}')::INT" for w in _WORDS)}) AS hits FROM p),
c AS (SELECT doc_id, CASE WHEN place > 0 THEN greatest(0.6, place) ELSE 0 END::DOUBLE AS region_confidence, least(1.0, hits / 5.0)::DOUBLE AS relevance FROM s)
SELECT doc_id, round(region_confidence, 6) AS region_confidence, round(relevance, 6) AS relevance, region_confidence >= 0.6 AND relevance >= 0.4 AS should_extract FROM c""")
def rule_verification(spark, sf_dir):
    d = profiles.verify(read(spark, sf_dir, "documents").select("doc_id", F.expr(_PAGE).alias("page")), "page", REGIONS["hamburg"], _WORDS)
    return d.select("doc_id", F.round(F.col("region_confidence").cast("double"), 6).alias("region_confidence"), F.round(F.col("relevance").cast("double"), 6).alias("relevance"), "should_extract")


_FOUND = {"url": "CASE turn % 5 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'https://x' END", "context": "CASE turn % 3 WHEN 0 THEN NULL ELSE 'c' END"}


@query(f"""WITH e AS (SELECT conv_id, turn, list_filter([CASE WHEN {_FOUND['url']} IS NULL THEN 'url' END, CASE WHEN {_FOUND['context']} IS NULL THEN 'context' END], lambda x: x IS NOT NULL) AS nulls, trim({_FOUND['url']}) = '' AS blank FROM conversations),
r AS (SELECT conv_id, turn, CASE WHEN len(nulls) > 0 THEN 'None/null values in fields: ' || array_to_string(nulls, ', ') WHEN blank THEN 'Empty string in fields: url' END AS reason FROM e)
SELECT conv_id, count(*) FILTER (reason IS NULL) AS n_valid, coalesce(string_agg(reason, '; ' ORDER BY turn) FILTER (reason IS NOT NULL), '') AS reasons FROM r GROUP BY 1""")
def discovered_validity(spark, sf_dir):
    one = F.struct("turn", F.col("role").alias("name"), F.expr(_FOUND["url"]).alias("url"), F.lit("b").alias("brief_description"), F.expr(_FOUND["context"]).alias("context"))
    c = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("e"))
    good, bad = profiles.split_discovered(F.col("e"))
    return c.select("conv_id", F.size(good).cast("bigint").alias("n_valid"), F.array_join(F.transform(bad, lambda x: x["reason"]), "; ").alias("reasons"))


@query("""WITH t AS (SELECT DISTINCT o_custkey AS k, 'https://c' || o_custkey || '-web.example.com' AS url FROM orders), d AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE 0.9 END AS confidence FROM customer WHERE c_nationkey < 12)
SELECT url, CASE WHEN d.confidence = 0 THEN 'minimal_profile' WHEN d.confidence IS NOT NULL THEN 'success' ELSE 'still_failed' END AS status, coalesce(name, 'C' || t.k || ' Web') AS name, coalesce(confidence, 0)::DOUBLE AS confidence FROM t LEFT JOIN d USING (k)""")
def minimal_profiles(spark, sf_dir):
    """Profiles of all customers with orders; those that weren't extracted are named by their host."""
    todo = read(spark, sf_dir, "orders").select(F.expr("'https://c' || o_custkey || '-web.example.com'").alias("url")).distinct()
    done = read(spark, sf_dir, "customer").where("c_nationkey < 12").selectExpr("'https://c' || c_custkey || '-web.example.com' AS url", "c_name AS name", "CAST(CASE WHEN c_acctbal < 0 THEN 0.0 ELSE 0.9 END AS double) AS confidence")
    return profiles.with_minimal(todo, done).select("url", "status", "name", "confidence")


_CANDIDATE = "CASE page_id % 6 WHEN 0 THEN 'https://www.linkedin.com/company/' || page_id WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN 'https://thea.example.md:8080/stiri/' || page_id WHEN 3 THEN 'https://tion' || page_id || '.md' ELSE url END"


@query(rf"""WITH c AS (SELECT page_id, {_CANDIDATE} AS u, strip_accents(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1))) AS t, strip_accents(lower(html)) AS b FROM pages), h AS (SELECT *, lower(regexp_extract(u, {_SPLIT}, 2)) AS h FROM c),
n AS (SELECT *, split_part(h, ':', 1) AS bare, len(list_filter(['thea', 'tion', 'ouzz'], lambda w: contains(t, w) OR contains(b, w))) AS n FROM h)
SELECT page_id, CASE WHEN h = '' OR len(list_filter({[*profiles.SOCIAL_HOSTS, *profiles.BLOCKED_HOSTS]!r}, lambda x: contains(h, x))) > 0 THEN -100
ELSE CASE WHEN ends_with(h, '.md') THEN 20 ELSE 0 END + 15 * least(n, 2) + CASE WHEN contains(bare, 'thea') OR contains(bare, 'tion') OR contains(bare, 'ouzz') THEN 25 ELSE 0 END + CASE WHEN contains(b, 'heen') THEN 10 ELSE 0 END
- CASE WHEN len(list_filter({profiles.LISTING_PARTS!r}, lambda x: contains(lower(u), x))) > 0 THEN 15 ELSE 0 END END AS points FROM n""", ints=("points",))
def candidate_points(spark, sf_dir):
    names = F.array(F.lit("thea"), F.lit("tion"), F.lit("ouzz"))
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(_CANDIDATE).alias("u"), markup.page_title(F.col("html")).alias("t"), "html")
    return p.select("page_id", profiles.candidate_points(F.col("u"), F.col("t"), F.col("html"), names, "heen", ".md").alias("points"))


_TITLED = "CASE page_id % 4 WHEN 0 THEN regexp_replace(html, '<title>[^<]*</title>', '<title> ab</title>') WHEN 1 THEN regexp_replace(html, '<title>[^<]*</title>', '<title> a  </title>') WHEN 2 THEN html ELSE '' END"


@query(rf"""WITH h AS (SELECT page_id, {_TITLED} AS h FROM pages), t AS (SELECT page_id, h, lower(regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)) AS t, lower(regexp_replace(regexp_extract(h, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g')) AS g, lower(h) AS b FROM h)
SELECT page_id, CASE WHEN h = '' THEN 0 ELSE 20 * least((contains(t, 'the') OR contains(g, 'the'))::INT + (contains(t, 'on') OR contains(g, 'on'))::INT, 2) + CASE WHEN contains(b, 'heen') THEN 15 ELSE 0 END - CASE WHEN length(t) < 4 THEN 5 ELSE 0 END END AS points FROM t""", ints=("points",))
def page_points(spark, sf_dir):
    names = F.array(F.lit("the"), F.lit("on"))
    p = read(spark, sf_dir, "pages").select("page_id", F.expr(_TITLED).alias("h"))
    title = F.regexp_extract("h", "(?is)<title[^>]*>(.*?)</title>", 1)
    return p.select("page_id", profiles.page_points(F.col("h"), title, markup.page_heading(F.col("h")), F.col("h"), names, "heen").alias("points"))


@query("""WITH s AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events), f AS (SELECT user_id, min(event_id) AS stop FROM s WHERE n > 1 GROUP BY 1)
SELECT e.user_id, e.event_id FROM events e LEFT JOIN f USING (user_id) WHERE stop IS NULL OR event_id < stop""")
def paging_stop(spark, sf_dir):
    return profiles.until_repeat(read(spark, sf_dir, "events"), "user_id", "event_id", "event_type").select("user_id", "event_id")


_AGENCY = "CASE c_custkey % 4 WHEN 0 THEN '„Agenția” ' || c_name || ' Întreprinderea Municipală S.R.L' WHEN 1 THEN 'SOCIETATEA COMERCIALĂ «Apă-Canal» SA' WHEN 2 THEN 'Institutul ' || c_mktsegment || ', II' ELSE c_name || ' Grupul' END"


@query(rf"""WITH n AS (SELECT c_custkey, lower(strip_accents({_AGENCY})) AS n FROM customer), p AS (SELECT c_custkey, list_reduce({profiles.LEGAL_PHRASES!r}, lambda a, x: replace(a, x, ' '), n) AS n FROM n)
SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(n, '(?i){'|'.join(f'(?:{x})' for x in profiles.LEGAL_FORMS)}', ' ', 'g'), '["''`“”„«»]+', ' ', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}_\s-]', ' ', 'g'), '\s+', ' ', 'g')) AS name FROM p""")
def agency_names(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", profiles.agency_name(F.expr(_AGENCY)).alias("name"))


@query("""SELECT * FROM (SELECT 0 AS src, 'a' || c_custkey AS name, 'https://c' || (c_custkey % 40) || '.example.com/x' AS url, 'Firms - ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS category, c_custkey AS k FROM customer UNION ALL SELECT 1, 'Say "' || s_suppkey || '"' || chr(10) || 'now', CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'https://s' || (s_suppkey % 40) || '.example.com' END, 'More', s_suppkey FROM supplier)
QUALIFY row_number() OVER (PARTITION BY url ORDER BY src, k) = 1""", ints=("src", "k"))
def csv_registry(spark, sf_dir):
    """Two sources written as CSV files and read back by the registry, with one that is missing; the first row of each address."""
    from ..scratch import place
    from ..sources import registry, sinks

    root = place(spark, "csv")
    c, s = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    sinks.csv_file(c.selectExpr("'https://c' || (c_custkey % 40) || '.example.com/x/?q=1' AS website", "'a' || c_custkey AS name", "c_mktsegment AS kind", "c_custkey AS k").orderBy("k"), f"{root}/a")
    site = "CASE s_suppkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN 's' || (s_suppkey % 40) || '.example.com' ELSE 'https://s' || (s_suppkey % 40) || '.example.com' END AS domain"
    sinks.csv_file(s.selectExpr(site, "'Say \"' || s_suppkey || '\"\n' || 'now' AS title", "s_suppkey AS k").orderBy("k"), f"{root}/b")
    sources = [registry.Source(f"{root}/a/*.csv", "website", "name", "Firms", "kind", multiline=False), registry.Source(f"{root}/b", "domain", "title", "More", add_protocol=True), registry.Source(f"{root}/gone", "u", "n", "x")]
    rows, _ = registry.scan(spark, sources)
    number = F.regexp_extract("name", "([0-9]+)", 1).cast("bigint")
    return dedupe.keep(rows, ["url"], ["src", "ord"]).select(F.col("src").cast("bigint").alias("src"), "name", "url", "category", number.alias("k"))


@query("SELECT n_nationkey AS k, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS version FROM nation", ints=("k", "version"))
def appended_cache(spark, sf_dir):
    """A lookup cache that is appended to; of each key the last row counts."""
    from ..scratch import place
    from ..sources import sinks

    root = place(spark, "cache")
    n = read(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS bigint) AS k", "n_name AS name")
    sinks.append_rows(n.withColumn("version", F.lit(1).cast("bigint")), root)
    sinks.append_rows(n.where("k % 2 = 0").withColumn("version", F.lit(2).cast("bigint")), root)
    return sinks.last_of(spark, root, ["k"])


@query("SELECT conv_id, count(*) FILTER (turn % 3 = 0) AS item, 'Org ' || min(turn) || ' Umwelt' || CASE WHEN count(*) > 1 THEN 'werk' ELSE '-' END || CASE WHEN count(*) > 2 THEN ' GmbH' ELSE '' END AS text FROM (SELECT conv_id, turn, sum((turn % 3 = 0)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM conversations) GROUP BY conv_id, g HAVING min(turn) % 3 = 0", ints=("item",))
def wrapped_bullets(spark, sf_dir):
    """Each conversation's turns as the lines of a page description, read back from its bytes."""
    line = F.expr("CASE turn % 3 WHEN 0 THEN '• Org ' || turn || ' Umwelt-' WHEN 1 THEN 'werk' ELSE 'GmbH' END")
    lines = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]).alias("lines"))
    content = F.pandas_udf(lambda s: s.map(lambda x: office.page_bytes([list(x)[:40], list(x)[40:]])), "binary")
    files = lines.select(F.col("conv_id").cast("string").alias("path"), content("lines").alias("content"))
    found = office.page_lines(files).select(F.col("path").cast("bigint").alias("conv_id"), F.struct("page", "line").alias("ord"), F.col("text").alias("line"))
    got = markup.bullets(found, "conv_id")
    return got.select("conv_id", F.lit(1).cast("bigint").alias("item"), "text")
