"""Queries over single-row operators: URLs, names, phones, titles, filters, scores, places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, scores, text, urls
from ..operators import hot, profiles
from ..regions import REGIONS
from .base import query, read

_SPLIT = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)'"


@query("SELECT page_id, regexp_replace(trim(url), '/$', '') AS cleaned, regexp_matches(trim(url), '^https?://') AS valid FROM pages")
def url_clean(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    return p.select("page_id", urls.clean(F.col("url")).alias("cleaned"), urls.is_valid(F.col("url")).alias("valid"))


@query(rf"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'n/a' WHEN page_id % 7 = 0 THEN regexp_replace(url, '^https?://', '') ELSE url END AS u FROM pages),
t AS (SELECT page_id, CASE WHEN lower(trim(u)) IN ('n/a', 'none', 'null', '-', '') THEN '' WHEN regexp_matches(lower(trim(u)), '^https?://') THEN trim(u) ELSE 'https://' || trim(u) END AS u FROM p),
s AS (SELECT page_id, lower(regexp_extract(u, {_SPLIT}, 1)) AS scheme, regexp_extract(u, {_SPLIT}, 2) AS host, regexp_replace(regexp_extract(u, {_SPLIT}, 3), ';[^/]*$', '') AS path FROM t)
SELECT page_id, CASE WHEN scheme IN ('http', 'https') AND host <> '' THEN scheme || '://' || host || CASE WHEN path <> '/' THEN regexp_replace(path, '/$', '') ELSE path END ELSE '' END AS normalized FROM s
""")
def url_normalize(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    u = F.when(F.col("page_id") % 11 == 0, "n/a").when(F.col("page_id") % 7 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(F.col("url"))
    return p.select("page_id", urls.normalize(u, add_protocol=True).alias("normalized"))


@query(rf"""SELECT page_id, lower(regexp_extract(url, {_SPLIT}, 1)) || '://' || lower(regexp_extract(url, {_SPLIT}, 2)) || regexp_replace(regexp_extract(url, {_SPLIT}, 3), '/+$', '') AS match_key,
lower(regexp_extract(url, {_SPLIT}, 2)) AS domain, regexp_replace(lower(regexp_extract(url, {_SPLIT}, 2)), '^www\.', '') AS bare, replace(lower(regexp_extract(url, {_SPLIT}, 2)), 'www.', '') AS without FROM pages""")
def url_domain(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.match_key(u).alias("match_key"), urls.domain(u).alias("domain"), urls.domain(u, "strip").alias("bare"), urls.domain(u, "remove").alias("without"))


@query(r"""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '^https?:', '') WHEN 1 THEN regexp_replace(url, '^https?://', '') WHEN 2 THEN 'https://' || url ELSE url END AS u FROM pages),
t AS (SELECT page_id, regexp_replace(trim(u), '^(?:https?:/*)+(https?://)', '\1') AS u FROM p)
SELECT page_id, CASE WHEN starts_with(u, '//') THEN 'https:' || u WHEN regexp_matches(u, '^https?://') THEN u ELSE 'https://' || u END AS repaired FROM t""")
def url_repair(spark, sf_dir):
    k = F.col("page_id") % 4
    u = F.when(k == 0, F.regexp_replace("url", "^https?:", "")).when(k == 1, F.regexp_replace("url", "^https?://", "")).when(k == 2, F.concat(F.lit("https://"), "url")).otherwise(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", urls.repair_scheme(u).alias("repaired"))


_TRACKED = "CASE page_id % 4 WHEN 0 THEN url || '?utm_source=x&a=1&gclid=2&b=2&utm_medium=y' WHEN 1 THEN url || '?a=1&fbclid=q#top' WHEN 2 THEN url || '&utm_campaign=z' ELSE url END"


def _untracked(c: str) -> str:
    return rf"regexp_replace(replace(regexp_replace({c}, '[?&](?:utm_[^=&]+|gclid|fbclid)=[^&]*', '', 'g'), '?&', '?'), '[?&]+$', '')"


@query(rf"""WITH p AS (SELECT page_id, {_TRACKED} AS u FROM pages),
d AS (SELECT page_id, u, regexp_replace(regexp_replace(trim(CASE WHEN page_id % 3 = 0 THEN '  (' || u || ').  ' WHEN page_id % 3 = 1 THEN regexp_replace(u, '^https?://', '') || ' 3  2' ELSE '' END), '^[).,;]+|[).,;]+$', '', 'g'), '\s+\d+(?:\s+\d+)*$', '') AS t, page_id % 3 = 2 AS blank FROM p),
h AS (SELECT *, CASE WHEN regexp_matches(t, '^https?://') THEN t ELSE 'https://' || t END AS w FROM d)
SELECT page_id, {_untracked('u')} AS stripped, CASE WHEN blank THEN '' ELSE {_untracked('w')} END AS cited FROM h""")
def url_trackers(spark, sf_dir):
    p = read(spark, sf_dir, "pages").withColumn("u", F.expr(_TRACKED))
    u, k = F.col("u"), F.col("page_id") % 3
    cited = F.when(k == 0, F.concat(F.lit("  ("), u, F.lit(").  "))).when(k == 1, F.concat(F.regexp_replace(u, "^https?://", ""), F.lit(" 3  2"))).otherwise("")
    return p.select("page_id", urls.without_trackers(u).alias("stripped"), urls.document_url(cited).alias("cited"))


_WRAPPED = "CASE page_id % 4 WHEN 0 THEN 'https://r.example.com/go?x=1&dest=' || url_encode(url) WHEN 1 THEN url WHEN 2 THEN 'https://r.example.com/go?url=ftp%3A%2F%2Fa&to=' || url_encode(url) || '&u=https%3A%2F%2Fb' ELSE 'https://r.example.com/go?link=mailto%3Aa' END"
_PARAMETERS = ("url", "dest", "destination", "to", "link", "u")


@query(f"""WITH p AS (SELECT page_id, {_WRAPPED} AS w FROM pages), g AS (SELECT page_id, w, [{', '.join(f"url_decode(regexp_extract(w, '[?&]{n}=([^&#]*)', 1))" for n in _PARAMETERS)}] AS t FROM p)
SELECT page_id, coalesce(list_filter(t, lambda x: starts_with(x, 'http'))[1], w) AS target FROM g""")
def url_redirect(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.unwrap(F.expr(_WRAPPED)).alias("target"))


@query(rf"""WITH h AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, {_SPLIT}, 2)), '^www\.', '') AS h FROM pages),
l AS (SELECT page_id, h, string_split(CASE WHEN page_id % 4 = 0 THEN '3d-' || page_id || 'print-' || h ELSE h END, '.') AS s, string_split(h, '.') AS o FROM h)
SELECT page_id, CASE WHEN h = 'therin.example.net' THEN 'Therin Works' WHEN ends_with(h, 'example.org') THEN 'Example Foundation' ELSE upper(o[-2][1]) || o[-2][2:] END AS organisation,
array_to_string(list_transform(regexp_extract_all(replace(s[1], '-', ' '), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '') AS display FROM l""")
def url_organisation(spark, sf_dir):
    known = {"therin.example.net": "Therin Works", "example.org": "Example Foundation"}
    host = urls.domain(F.col("url"), "strip")
    shown = F.concat(F.lit("https://"), F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("3d-"), "page_id", F.lit("print-"), host)).otherwise(host))
    return read(spark, sf_dir, "pages").select("page_id", urls.organisation(F.col("url"), known).alias("organisation"), urls.display_name(shown).alias("display"))


@query(rf"SELECT page_id FROM pages WHERE NOT (regexp_extract(url, {_SPLIT}, 2) LIKE '%example.net%' OR regexp_extract(url, {_SPLIT}, 2) LIKE '%blog.%') AND regexp_matches(url, '^https?://[^/]*[.](com|org)(/|$)')")
def url_blocklist(spark, sf_dir):
    host = urls.domain(F.col("url"))
    return read(spark, sf_dir, "pages").where(~urls.has_any(host, ["example.net", "blog."]) & (host.endswith(".com") | host.endswith(".org"))).select("page_id")


@query("""SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) AS category, array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title,
CASE WHEN p_size % 5 = 0 THEN 'Parts' ELSE 'Parts - ' || array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') END AS full_category FROM part""")
def category_title(spark, sf_dir):
    custom = F.when(F.col("p_size") % 5 == 0, F.lit(" ")).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", text.category(F.col("p_type"), "Other").alias("category"), text.title(F.col("p_name")).alias("title"), text.source_category(F.lit("Parts"), custom).alias("full_category"))


_NAMES = "CASE c_custkey % 9 WHEN 0 THEN '  Grün Recycling ' || c_custkey || ' GmbH' WHEN 1 THEN 'Öko Werk AG & Co. KG' WHEN 2 THEN c_name || ' d.o.o.' WHEN 3 THEN 'Foo Agentur ' || c_mktsegment WHEN 4 THEN 'Verlag' WHEN 5 THEN 'Green Ltd.' WHEN 6 THEN c_name || '  GmbH &  Co. KG' WHEN 7 THEN 'S.C. ' || c_name || ' S.R.L.' ELSE ' ' END"


@query(f"""WITH p AS (SELECT c_custkey, lower(trim({_NAMES})) AS n FROM customer)
SELECT c_custkey, trim(regexp_replace(list_reduce({text.LEGAL_SUFFIXES!r}, lambda a, x: replace(CASE WHEN ends_with(a, x) THEN trim(a[1:length(a) - length(x)]) ELSE a END, ' ' || x, ''), n), '\\s+', ' ', 'g')) AS name FROM p""")
def legal_suffix_normalize(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", text.legal_name(F.expr(_NAMES)).alias("name"))


_OPEN = "concat_ws(' ', c_name, lower(c_mktsegment), CASE c_custkey % 4 WHEN 0 THEN 'Institute of Technology' WHEN 1 THEN 'Universität & Hochschule e.V.' WHEN 2 THEN 'Schools GmbH' ELSE 'Center' END, CAST(c_nationkey AS varchar(9)))"


@query(rf"""SELECT c_custkey, trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({_OPEN})), '[^a-z0-9]+', ' ', 'g'), '\b(?:{'|'.join(text.OPEN_STOPLIST)}|e v)\b', ' ', 'g'), '\s+', ' ', 'g')) AS open_name,
regexp_replace(trim({_OPEN}), '\s+\d+$', '') AS counted FROM customer""")
def open_name_normalize(spark, sf_dir):
    n = F.expr(_OPEN.replace("varchar(9)", "string"))
    return read(spark, sf_dir, "customer").select("c_custkey", text.open_name(n).alias("open_name"), text.drop_count(n).alias("counted"))


@query(r"""WITH p AS (SELECT c_custkey, regexp_replace(CASE c_custkey % 5 WHEN 0 THEN '+49 (40) ' WHEN 1 THEN '+381 21 ' WHEN 2 THEN '+373 ' WHEN 3 THEN '040/' ELSE '40 ' END || c_custkey, '[^0-9]', '', 'g') AS d FROM customer)
SELECT c_custkey, CASE WHEN starts_with(d, '49') THEN d[3:] WHEN starts_with(d, '381') OR starts_with(d, '373') THEN d[4:] WHEN starts_with(d, '40') THEN d[3:] ELSE d END AS phone FROM p""")
def phone_normalize(spark, sf_dir):
    k = F.col("c_custkey") % 5
    p = F.concat(F.when(k == 0, "+49 (40) ").when(k == 1, "+381 21 ").when(k == 2, "+373 ").when(k == 3, "040/").otherwise("40 "), F.col("c_custkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", text.phone(p).alias("phone"))


@query(r"""SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}_]+'), lambda t: length(t) >= 3 AND t NOT IN ('the', 'and')) AS tokens,
trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g')) AS squeezed FROM documents""", lists=("tokens",))
def text_tokens(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", text.tokens(F.col("text"), stop=["the", "and"]).alias("tokens"), text.squeeze(F.col("text")).alias("squeezed"))


@query("SELECT doc_id, strip_accents(text) AS plain FROM documents")
def accent_strip(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.strip_marks(F.col("text")).alias("plain"))


@query("SELECT doc_id, text AS repaired FROM documents")
def mojibake_repair(spark, sf_dir):
    """Every other text that can be is read in the wrong encoding first; all come out whole."""
    t = F.col("text")
    broken = F.when((F.col("doc_id") % 2 == 0) & ~t.rlike("[^\\x00-\\x{7FF}]"), F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")).otherwise(t)
    return read(spark, sf_dir, "documents").select("doc_id", text.repair_encoding(broken).alias("repaired"))


_ADDRESS = "CASE WHEN c_custkey % 3 = 0 THEN c_name || ', HAMBURG, Germany' ELSE c_name END"


@query(f"""SELECT c_custkey, lower('10.1/' || c_name) AS doi, c_name[1:10] AS address_key, length(c_name) // 4 AS tokens, round(CASE WHEN c_acctbal > 1 THEN c_acctbal / 100 ELSE c_acctbal END, 6) AS share,
sha256(c_name) AS cache_key, CASE WHEN contains(lower({_ADDRESS}), ', hamburg, germany') THEN {_ADDRESS} ELSE {_ADDRESS} || ', Hamburg, Germany' END AS geo_query, 'partner: ' || c_name AS evidence, c_mktsegment || ' -> ' || c_name AS chain, '<a href="' || c_name || '">' || c_mktsegment || '</a>' AS anchor FROM customer""")
def projections(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), F.col("c_name")
    return c.select(
        "c_custkey", text.doi(F.concat(F.lit(" https://doi.org/10.1/"), n)).alias("doi"), F.substring(n, 1, 10).alias("address_key"), F.floor(F.char_length(n) / 4).alias("tokens"),
        F.round(text.share(F.col("c_acctbal")), 6).alias("share"), F.sha2(n, 256).alias("cache_key"), text.place_query(F.expr(_ADDRESS), REGIONS["hamburg"].suffix).alias("geo_query"),
        F.format_string("partner: %s", n).alias("evidence"), F.concat_ws(" -> ", "c_mktsegment", n).alias("chain"), F.format_string('<a href="%s">%s</a>', n, F.col("c_mktsegment")).alias("anchor"),
    )


@query(r"""SELECT p_partkey, regexp_replace(p_size || '. ' || p_name, '^\s*\d+[.)]\s*', '') AS unnumbered, split_part(p_name, ' ', 1) AS short FROM part""")
def name_parts(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    return p.select("p_partkey", text.drop_numbering(F.concat(F.col("p_size").cast("string"), F.lit(". "), "p_name")).alias("unnumbered"), text.short_name(F.regexp_replace("p_name", " ", " | ")).alias("short"))


_LAT, _LON = "(53.5511 + (n_nationkey - 12) * 0.03)", "(9.9937 + (n_nationkey % 5) * 0.05)"
_KM = f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({_LAT} - 53.5511) / 2), 2) + cos(radians(53.5511)) * cos(radians({_LAT})) * pow(sin(radians({_LON} - 9.9937) / 2), 2))))"


@query(f"SELECT n_nationkey, round({_KM}, 6) AS km, round({_KM}, 6) AS km_atan, {_KM} <= 30 AS near FROM nation", ints=("n_nationkey",))
def geo_distance(spark, sf_dir):
    n = read(spark, sf_dir, "nation").withColumns({"lat": F.expr(_LAT).cast("double"), "lon": F.expr(_LON).cast("double")})
    a = (F.lit(53.5511), F.lit(9.9937), F.col("lat"), F.col("lon"))
    return n.select("n_nationkey", F.round(geo.haversine(*a), 6).alias("km"), F.round(geo.haversine_atan(*a), 6).alias("km_atan"), (geo.haversine(*a) <= 30).alias("near"))


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 53.550341 ELSE 53.6 END AS lat, 10.000654 AS lon,
CASE WHEN c_custkey % 6 = 0 THEN ' N/A ' WHEN c_custkey % 6 = 1 THEN NULL ELSE c_name END AS a FROM customer)
SELECT c_custkey, lat IS NULL OR (abs(lat - 53.550341) < 1e-6 AND abs(lon - 10.000654) < 1e-6) AS needs, a IS NOT NULL AND lower(trim(a)) NOT IN ('', 'unknown', 'na', 'n/a', 'none') AS has_address FROM c""")
def needs_geocoding(spark, sf_dir):
    k = F.col("c_custkey")
    lat = F.when(k % 4 == 0, None).when(k % 4 == 1, 53.550341).otherwise(53.6)
    a = F.when(k % 6 == 0, " N/A ").when(k % 6 == 1, None).otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").select("c_custkey", geo.needs_geocoding(lat, F.lit(10.000654), REGIONS["hamburg"].centre).alias("needs"), geo.has_address(a).alias("has_address"))


@query("""WITH t AS (SELECT p_partkey, p_name, list_transform(string_split(p_type || ', ' || p_brand, ','), lambda x: lower(trim(x))) AS t FROM part)
SELECT p_partkey, CASE WHEN list_has_any(t, ['promo']) THEN true ELSE NOT list_has_any(t, ['economy', 'small']) END AS keep FROM t""")
def type_relevance(spark, sf_dir):
    t = scores.types(F.concat_ws(", ", "p_type", "p_brand"))
    return read(spark, sf_dir, "part").select("p_partkey", scores.relevant_type(t, ["promo"], ["economy", "small"]).alias("keep"))


_SCORE = """greatest(0, least(100, 50 + CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'gear') THEN 10 ELSE 0 END + CASE WHEN contains(lower(p_brand), 'ring') OR contains(lower(p_brand), 'gear') THEN 5 ELSE 0 END
+ CASE WHEN p_type = 'PROMO' THEN 15 ELSE 0 END - CASE WHEN contains(p_name, 'hot') OR contains(p_name, 'red') THEN 20 ELSE 0 END - CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 25 ELSE 0 END
+ CASE WHEN p_size % 2 = 0 THEN 5 ELSE 0 END + CASE WHEN p_retailprice / 400 >= 4.5 THEN 5 WHEN p_retailprice / 400 >= 4.0 THEN 3 ELSE 0 END))::DOUBLE"""


def _scored(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    s = scores.relevance(F.col("p_name"), F.col("p_brand"), scores.types(F.col("p_type")), F.when(F.col("p_size") % 2 == 0, "w"), F.col("p_retailprice") / 400, ["ring", "gear"], ["hot", "red"], ["promo"], ["economy", "small"])
    return p.select("p_partkey", "p_type", "p_name", s.alias("score"))


@query(f"SELECT p_partkey, {_SCORE} AS score FROM part")
def relevance_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("p_partkey", "score")


@query(f"WITH s AS (SELECT {_SCORE} AS score FROM part) SELECT count(*) FILTER (score > 70) AS high, count(*) FILTER (score BETWEEN 50 AND 70) AS middle, count(*) FILTER (score < 50) AS low FROM s")
def score_bands(spark, sf_dir):
    s = F.col("score")
    return _scored(spark, sf_dir).agg(F.count_if(s > 70).alias("high"), F.count_if((s >= 50) & (s <= 70)).alias("middle"), F.count_if(s < 50).alias("low"))


@query(f"WITH s AS (SELECT p_partkey, p_type, p_name, {_SCORE} AS score FROM part) SELECT p_type, score, p_name, p_partkey FROM s WHERE score >= 60 ORDER BY p_type, score DESC, p_name, p_partkey LIMIT 50")
def score_top(spark, sf_dir):
    return _scored(spark, sf_dir).where("score >= 60").orderBy("p_type", F.desc("score"), "p_name", "p_partkey").limit(50).select("p_type", "score", "p_name", "p_partkey")


_LOCAL = r"(regexp_matches(lower(text), '\b2[0-2][0-9]{3}\b')::INT + (contains(lower(text), 'hamburg') OR contains(lower(text), 'altona') OR contains(lower(text), 'eimsbüttel') OR contains(lower(text), 'wandsbek') OR contains(lower(text), 'bergedorf') OR contains(lower(text), 'harburg'))::INT + regexp_matches(lower(text), '\+49 40|\b040\b')::INT) / 3.0"


_PLACED = "CASE doc_id % 4 WHEN 0 THEN text || ' 20539 Hamburg' WHEN 1 THEN text || ' 040 1' WHEN 2 THEN text || ' НОВИ САД 21000' ELSE text END"
_LOCAL_2 = rf"(regexp_matches(lower(text), '\b21[0-9]{{3}}\b')::INT + ({' OR '.join(f"contains(lower(text), '{n}')" for n in REGIONS['novi_sad'].names)})::INT + regexp_matches(lower(text), '\+381 21|\b021\b|\+381 \(0\)21')::INT) / 3.0"


@query(f"WITH t AS (SELECT doc_id, doc_id % 20 / 20.0 AS c, ({_LOCAL})::DOUBLE AS s, ({_LOCAL_2})::DOUBLE AS s2 FROM (SELECT doc_id, {_PLACED} AS text FROM documents)) SELECT doc_id, round(s, 6) AS locality, round(s2, 6) AS second, c < 0.6 AND greatest(c, s) >= 0.6 OR c >= 0.6 AS based, round(CASE WHEN c < 0.6 THEN greatest(c, s) ELSE c END, 6) AS confidence FROM t")
def locality_score(spark, sf_dir):
    t = F.expr(_PLACED)
    d = read(spark, sf_dir, "documents").select("doc_id", scores.locality(t, REGIONS["hamburg"]).alias("s"), scores.locality(t, REGIONS["novi_sad"]).alias("s2"), (F.col("doc_id") % 20 / 20.0).alias("c"))
    based, conf = scores.boost(F.col("c") >= 0.6, F.col("c"), F.col("s"))
    return d.select("doc_id", F.round("s", 6).alias("locality"), F.round("s2", 6).alias("second"), based.alias("based"), F.round(conf, 6).alias("confidence"))


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Public Authorities' WHEN 'BUILDING' THEN 'Non-Governmental Organizations' WHEN 'AUTOMOBILE' THEN 'Students' WHEN 'HOUSEHOLD' THEN 'Funding Bodies' ELSE 'Industry Partners' END AS role FROM customer""")
def role_parse(spark, sf_dir):
    s = F.col("c_mktsegment")
    said = F.when(s == "MACHINERY", " public policy unit").when(s == "BUILDING", "ngo network").when(s == "AUTOMOBILE", "STUDENTS").when(s == "HOUSEHOLD", "funding Bodies ").otherwise("xyz")
    return read(spark, sf_dir, "customer").select("c_custkey", scores.role(said).alias("role"))


@query("""WITH t AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'directory' ELSE 'site' END AS kind, (page_id * 7) % 101 AS score FROM pages)
SELECT page_id, CASE WHEN kind = 'directory' THEN CASE WHEN score >= 30 THEN 'directory' ELSE 'not-found' END WHEN score >= 70 THEN 'accepted' WHEN score >= 40 THEN 'review-needed' ELSE 'not-found' END AS tier FROM t""")
def decision_tiers(spark, sf_dir):
    kind = F.when(F.col("page_id") % 3 == 0, "directory").otherwise("site")
    return read(spark, sf_dir, "pages").select("page_id", scores.tier(kind, (F.col("page_id") * 7) % 101).alias("tier"))


@query("""SELECT event_id, (CASE event_type WHEN 'error' THEN 0.85 WHEN 'click' THEN 0.75 ELSE 0.65 END)::DOUBLE AS confidence, CASE event_type WHEN 'error' THEN 'high' WHEN 'click' THEN 'medium' ELSE 'low' END AS priority,
CASE WHEN user_id % 3 = 0 THEN 'minimal_profile' WHEN user_id % 3 = 1 THEN 'success' ELSE 'still_failed' END AS retry, json_extract(props, '$.k')::BIGINT AS k FROM events""")
def severity_retry_json(spark, sf_dir):
    t = F.col("event_type")
    c, p = scores.severity(F.when(t == "error", "critical").when(t == "click", "significant").otherwise("minor"))
    r = scores.retry_status(F.when(F.col("user_id") % 3 == 0, 0.0).when(F.col("user_id") % 3 == 1, 0.8))
    return read(spark, sf_dir, "events").select("event_id", c.cast("double").alias("confidence"), p.alias("priority"), r.alias("retry"), F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT page_id, 5 * len(list_filter(['the', 'tion', 'zz'], lambda t: contains(split_part(regexp_extract(url, '://([^/?#]*)', 1), '.', 1), t))) + CASE WHEN contains(split_part(regexp_extract(url, '://([^/?#]*)', 1), '.', 1), 'ttz') THEN 2 ELSE 0 END AS score FROM pages""")
def domain_match_score(spark, sf_dir):
    names = F.array(F.lit("the"), F.lit("tion"), F.lit("zz"))
    return read(spark, sf_dir, "pages").select("page_id", scores.domain_match(names, urls.domain(F.col("url"))).alias("score"))


_ITEM = """CASE WHEN contains(lower(n), q) OR contains(lower(d), q) THEN CASE WHEN lower(n) = q THEN 1.0 ELSE 0.85 END
WHEN len(list_intersect(w, v)) / len(list_distinct(w || v)) >= 0.7 THEN len(list_intersect(w, v)) / len(list_distinct(w || v)) ELSE 0.0 END::DOUBLE"""


@query(f"""WITH i AS (SELECT p_partkey, unnest([{{'k': 0, 'n': p_name, 'd': 'made of ' || p_type}}, {{'k': 1, 'n': p_brand, 'd': p_name}}, {{'k': 2, 'n': 'Ring', 'd': 'red ' || p_type}}]) AS i, CASE WHEN p_partkey % 2 = 0 THEN 'red ring' ELSE 'promo ring red' END AS q FROM part),
w AS (SELECT p_partkey, i.k AS k, i.n AS n, i.d AS d, q, string_split(lower(i.n || ' ' || i.d), ' ') AS w, string_split(q, ' ') AS v FROM i), s AS (SELECT p_partkey, k, n, {_ITEM} AS s FROM w)
SELECT p_partkey, max(s) AS score, coalesce(list(n ORDER BY k) FILTER (s > 0), []) AS matched FROM s GROUP BY 1""", lists=("matched",))
def capability_search(spark, sf_dir):
    item = lambda n, d: F.struct(n.alias("name"), d.alias("description"))
    name, kind = F.col("p_name"), F.col("p_type")
    items = F.array(item(name, F.concat(F.lit("made of "), kind)), item(F.col("p_brand"), name), item(F.lit("Ring"), F.concat(F.lit("red "), kind)))
    q = F.when(F.col("p_partkey") % 2 == 0, "red ring").otherwise("promo ring red")
    p = hot.dealt(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand"), read(spark, sf_dir, "part").count(), "p_partkey")  # a small file of many rows is one task's
    got = p.select("p_partkey", scores.items_match(q, items).alias("m"))
    return got.select("p_partkey", F.col("m.score").cast("double").alias("score"), "m.matched")


@query("SELECT c_custkey FROM customer WHERE (c_nationkey = 5 AND c_mktsegment = 'BUILDING') OR (c_nationkey = 6 AND c_acctbal > 5000)")
def geo_column_filters(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.where("(c_nationkey = 5 AND c_mktsegment = 'BUILDING') OR (c_nationkey = 6 AND c_acctbal > 5000)").select("c_custkey")


_KINDS = "CASE WHEN doc_id % 5 = 0 THEN text || ' Gospodărie Țărănească' WHEN doc_id % 5 = 1 THEN text || ' ÎNTREPRINDEREA INDIVIDUALĂ' ELSE text END"


@query(rf"""SELECT doc_id, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.') AS has_mail, regexp_matches(text, '\+?[0-9][0-9 ()/-]{{6,}}') AS has_phone,
contains(lower(strip_accents(text)), 'thea') AS any_cell, regexp_matches(lower(text), '\b(the|and)\b') AS pattern_hit, len(list_filter({profiles.SKIPPED_KINDS!r}, lambda p: contains(strip_accents(lower({_KINDS} || ' ' || lang)), p))) > 0 AS skipped FROM documents""")
def row_filters(spark, sf_dir):
    t = F.col("text")
    cell = F.exists(F.array(t, F.col("lang")), lambda c: F.lower(text.strip_marks(c)).contains("thea"))
    skipped = profiles.skipped_kind([F.expr(_KINDS), F.col("lang")])
    return read(spark, sf_dir, "documents").select("doc_id", t.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.").alias("has_mail"), t.rlike(r"\+?[0-9][0-9 ()/-]{6,}").alias("has_phone"), cell.alias("any_cell"), F.lower(t).rlike(r"\b(the|and)\b").alias("pattern_hit"), skipped.alias("skipped"))


_MEMBERS = "CASE c_custkey % 6 WHEN 0 THEN c_name || ' info@x' WHEN 1 THEN 'Email ' || c_name WHEN 2 THEN 'Call +381 21 555' WHEN 3 THEN replace(c_name, '#', ' nr ') ELSE 'Works ' || c_mktsegment END"
_MEMBER_SITES = "CASE WHEN c_custkey % 10 = 9 THEN 'no address' WHEN c_custkey % 10 = 8 THEN 'https://www.own.rs/' || c_custkey ELSE 'https://m' || c_custkey || '.rs' END"


@query(rf"""WITH m AS (SELECT c_custkey, {_MEMBERS} AS n, regexp_replace(lower(regexp_extract({_MEMBER_SITES}, '://([^/?#]*)', 1)), '^www\.', '') AS h FROM customer)
SELECT c_custkey FROM m WHERE h <> '' AND NOT ends_with(h, 'own.rs') AND NOT contains(n, '@') AND NOT contains(lower(n), 'email') AND NOT regexp_matches(n, '\b\+?\d[\d\s()./-]{{5,}}')""")
def member_noise(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    return c.where(~profiles.noisy_member(F.expr(_MEMBERS), F.expr(_MEMBER_SITES), "own.rs")).select("c_custkey")
