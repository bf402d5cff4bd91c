"""Text out of markup: HTML pages, XML records, Markdown sections, text blocks, documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators.dedupe import keep
from ..operators.scan import scan


def page_text(html: Column, limit: int = 15_000, url: Column | None = None) -> Column:
    """Visible text of a page: no script, style, nav and footer, tags as blanks, entities of
    the common kind decoded, white space squeezed, at most limit characters, which include
    a line '=== url ===' before it if an address is given."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?is)<(script|style|nav|footer)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    return F.substring(t if url is None else F.concat(F.lit("=== "), url, F.lit(" ===\n"), t), 1, limit)


def site_text(pages: DataFrame, key: str, order: str, html: str = "html", url: str = "url", limit: int = 15_000) -> DataFrame:
    """(key, text): the texts of a site's pages in order, each under its address, together at
    most limit characters; no page gives more than that many, so a row stays bounded."""
    t = pages.select(key, F.struct(order, page_text(F.col(html), limit, F.col(url)).alias("t")).alias("p"))
    return t.groupBy(key).agg(F.substring(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["t"]), "\n\n"), 1, limit).alias("text"))


def _text(html: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(html, r"(?s)<[^>]*>", " "), r"\s+", " "))


def _attribute(tag: Column, name: str) -> Column:
    return F.trim(F.regexp_extract(tag, rf"(?is)(?<![\w-]){name}\s*=\s*[\"']([^\"']*)[\"']", 1))


def page_heading(html: Column, levels: str = "1") -> Column:
    """Text of the first heading of some levels."""
    return _text(F.regexp_extract(html, rf"(?is)<h([{levels}])\b[^>]*>(.*?)</h\1\s*>", 2))


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def anchors(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, ord, href, label) of every anchor; label is its text without tags."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>.*?</a>"), F.lit(0))
    a = pages.select(key, F.posexplode(found).alias("ord", "a"))
    href = F.regexp_extract("a", r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)
    return a.select(key, "ord", href.alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a", r"(?s)<[^>]*>", " "), r"\s+", " ")).alias("label"))


def anchor_details(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """(*keys, ord, href, label, title, aria, alt, has_image, target, rel, data) of every anchor."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0))
    a = pages.select(*keys, F.posexplode(found).alias("ord", "a")).withColumn("tag", F.regexp_extract("a", r"(?is)^<a\b[^>]*>", 0))
    tag, image = F.col("tag"), F.regexp_extract("a", r"(?is)<img\b[^>]*>", 0)
    given = F.coalesce(*(F.nullif(_attribute(tag, x), F.lit("")) for x in ("data-url", "data-href", "data-website")), F.lit(""))
    alt = F.coalesce(F.nullif(_attribute(image, "alt"), F.lit("")), _attribute(image, "title"))
    return a.select(
        *keys, "ord", _attribute(tag, "href").alias("href"), _text(F.col("a")).alias("label"), _attribute(tag, "title").alias("title"), _attribute(tag, "aria-label").alias("aria"),
        alt.alias("alt"), (image != "").alias("has_image"), _attribute(tag, "target").alias("target"), _attribute(tag, "rel").alias("rel"), given.alias("data"),
    )


def external(df: DataFrame, href: str = "href", own: str = "own", blocked: list[str] = urls.SOCIAL) -> DataFrame:
    """Anchors to other hosts that aren't on the block list."""
    h = urls.domain(F.col(href), "strip")
    return df.where((h != "") & (h != F.col(own)) & ~urls.has_any(h, blocked))


def best_link(df: DataFrame, key: str | list[str], score: Column, order: str = "ord", href: str = "href") -> DataFrame:
    """The best scored link of each key, the first of equals; negative scores are out."""
    d = df.withColumn("score", score).where("score >= 0")
    return d.groupBy(*([key] if isinstance(key, str) else key)).agg(F.max_by(href, F.struct("score", (-F.col(order)).alias("o"))).alias(href), F.max("score").alias("score"))


def fallback_name(*candidates: Column) -> Column:
    """The first candidate that isn't blank: say anchor text, title, image text, heading, host."""
    return F.coalesce(*(F.nullif(F.trim(c), F.lit("")) for c in candidates))


# Labels that name a website, hosts that are nobody's own, and portals.
WEBSITE_LABELS = ["website", "webseite", "zur website", "homepage", "zur homepage", "internetseite", "zur internetseite"]
NOT_OWN = [
    "branchenbuch.hamburg.de", "google.", "maps.google", "hvv.de", "geofox.de", "booking.com", "yelp.", "tripadvisor.", "facebook.com", "instagram.com",
    "x.com", "twitter.com", "berlin.de",
]
PORTALS = ["hamburg.de", "berlin.de"]
# Words that don't tell companies apart.
COMPANY_STOPLIST = [
    "gmbh", "mbh", "kg", "ag", "ug", "ev", "e.v", "gbr", "ohg", "co", "und", "the", "hamburg", "firma", "betrieb", "service", "services", "recycling", "gruppe",
]


def company_tokens(name: Column) -> Column:
    """Words of three letters or more of a company's name that tell it apart."""
    t = F.split(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9äöüß\s-]", " "), r"[\s-]+")
    return F.filter(t, lambda x: (F.char_length(x) >= 3) & ~x.isin(COMPANY_STOPLIST))


def linked_data(html: Column) -> Column:
    """The first JSON-LD object of a page that has a type, as a variant; a list gives its first
    such element. What doesn't parse is passed over."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    read = F.filter(F.transform(raw, lambda x: F.try_parse_json(x)), lambda v: v.isNotNull())
    listed = F.flatten(F.transform(read, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    return F.get(F.filter(listed, lambda v: F.try_variant_get(v, "$['@type']", "variant").isNotNull()), F.lit(0))


def _strings(v: Column, path: str) -> Column:
    """A value of linked data that is a string, or a list of them, as an array."""
    one, many = F.try_variant_get(v, path, "string"), F.try_variant_get(v, path, "array<string>")
    return F.coalesce(many, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def website(pages: DataFrame, key: str, name: Column, html: str = "html") -> DataFrame:
    """(key, website, tier): an organisation's own site by a page about it: its linked data (0),
    an anchor whose label says website (1), around an image (2), whose host has a word of the
    name (3), or any other (4); the first of the best tier. Redirects are unwrapped; blocked
    addresses and portals are out; pages without one have no row."""
    own = lambda u: u.startswith("http") & ~urls.has_any(u, NOT_OWN) & ~urls.has_any(urls.hostname(u), PORTALS)
    d = pages.withColumn("__tokens", company_tokens(name))
    data = linked_data(F.col(html))
    said = F.flatten(F.array(*(_strings(data, f"$['{k}']") for k in ("url", "sameAs", "@id"))))
    told = F.filter(F.transform(said, lambda u: urls.unwrap(u)), own)
    first = d.select(key, F.lit(0).alias("tier"), F.lit(0).alias("ord"), F.get(told, F.lit(0)).alias("website")).where("website IS NOT NULL")
    a = anchor_details(d, [key, "__tokens"], html).withColumn("website", urls.unwrap(F.when(F.col("data") != "", F.col("data")).otherwise(F.col("href")))).where(own(F.col("website")))
    label = F.lower(F.coalesce(fallback_name(F.col("label"), F.col("aria"), F.col("title")), F.lit("")))
    host = urls.hostname(F.col("website"))
    tier = F.when(urls.has_any(label, WEBSITE_LABELS), 1).when(F.col("has_image"), 2).when(F.exists("__tokens", lambda t: host.contains(t)), 3).otherwise(4)
    every = first.unionByName(a.select(key, tier.alias("tier"), "ord", "website"))
    return every.groupBy(key).agg(F.min_by("website", F.struct("tier", "ord")).alias("website"), F.min("tier").alias("tier"))


def details(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, name, phone, email, address, latitude, longitude, image) of a page about an
    organisation, '' for what it lacks. Name: linked data, else the first heading of level 1
    or 2; address: linked data, an address element, item properties, else an element whose
    class or id says address and that has a digit."""
    h = F.col(html)
    d = pages.select(key, h.alias("h"), linked_data(h).alias("v"))
    v, h = F.col("v"), F.col("h")
    get = lambda path: F.coalesce(F.trim(F.try_variant_get(v, path, "string")), F.lit(""))
    parts = lambda *c: F.trim(F.array_join(F.filter(F.array(*c), lambda x: x != ""), " "))
    item = lambda p: _text(F.regexp_extract(h, rf"(?is)<(\w+)\b[^>]*itemprop\s*=\s*[\"']{p}[\"'][^>]*>(.*?)</\1\s*>", 2))
    element = _text(F.regexp_extract(h, r"(?is)<address\b[^>]*>(.*?)</address\s*>", 1))
    marked = F.regexp_extract_all(h, F.lit(r"(?is)<(\w+)\b[^>]*(?:class|id)\s*=\s*[\"'][^\"']*(?:address|adresse|anschrift)[^\"']*[\"'][^>]*>(.*?)</\1\s*>"), F.lit(2))
    marked = F.get(F.filter(F.transform(marked, _text), lambda t: t.rlike("[0-9]")), F.lit(0))
    link = lambda kind: F.trim(F.regexp_extract(h, rf"(?is)<a\b[^>]*href\s*=\s*[\"']{kind}:([^\"']*)[\"']", 1))
    image = F.trim(F.regexp_extract(F.regexp_extract(h, r"(?is)<meta\b[^>]*property\s*=\s*[\"']og:image[\"'][^>]*>", 0), r"(?is)content\s*=\s*[\"']([^\"']*)[\"']", 1))
    blank = lambda c, name: F.coalesce(c, F.lit("")).alias(name)
    return d.select(
        key, blank(fallback_name(get("$.name"), page_heading(h, "12")), "name"), blank(link("tel"), "phone"), blank(link("mailto"), "email"),
        blank(fallback_name(parts(get("$.address.streetAddress"), get("$.address.postalCode"), get("$.address.addressLocality")), element, parts(item("streetAddress"), item("postalCode"), item("addressLocality")), marked), "address"),
        get("$.geo.latitude").alias("latitude"), get("$.geo.longitude").alias("longitude"), blank(image, "image"),
    )


# Labels that lead to a website, and headings that are no names.
CARD_LABELS = ["zur website", "website", "webseite", "homepage", "mehr erfahren", "mehr infos"]
IGNORED_HEADINGS = [
    "retech", "mitglieder", "jetzt", "kontakt", "additional", "links", "tätigkeitsbereich", "wertschöpfungskettenbereich", "forschung", "entwicklung",
    "beratung", "planung", "logistik", "management", "rechtlicher", "rahmen", "epr", "maschinen", "anlagenbau", "abfallmanagement", "markterweiterung",
    "exportförderung", "sonstiges",
]


def name_link_points(url: Column, label: Column, target: Column, name_tokens: Column) -> Column:
    """Points of a profile's link: 3 for a bare address at a usual ending, the host's match with
    the name, 2 for a label that says website, 1 for a new window."""
    from ..functions.scores import domain_match

    bare = url.rlike(r"(?i)^https?://[^/]*\.(com|de|io|net|org)/?$")
    says = urls.has_any(F.lower(label), ["website", "webseite", "homepage", "zur website"])
    return F.when(bare, 3).otherwise(0) + domain_match(name_tokens, urls.domain(url, "remove")) + F.when(says, 2).otherwise(0) + F.when(target == "_blank", 1).otherwise(0)


def text_host_points(host: Column, name_tokens: Column) -> Column:
    """Points of a host name found in a text: its match with the name, more for fewer hyphens."""
    from ..functions.scores import domain_match

    return domain_match(name_tokens, host) + F.greatest(F.lit(0), 4 - F.regexp_count(host, F.lit("-")))


def card_link_points(url: Column, label: Column, rel: Column, target: Column, name: Column, own: str, social: list[str] = urls.SOCIAL) -> Column:
    """Points of a card's link: -1 for the own and social hosts; 4 for a label that leads to a
    website, 2 for a host name, 1 each for an external link and a new window, 4 if the host's
    label before the last one occurs in the name."""
    host = urls.domain(url)
    label_of = F.element_at(F.split(host, r"\."), F.when(F.size(F.split(host, r"\.")) > 1, -2).otherwise(-1))
    bare = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"\b(gmbh & co\.? kg|gmbh & co|gmbh|ag|kg|ug|e\.v\.|e\.v|ev|mbh)\b", "")
    if_ = lambda c, v: F.when(c, v).otherwise(0)
    points = if_(urls.has_any(F.lower(label), CARD_LABELS), 4) + if_(url.rlike(r"(?i)([a-z0-9-]+\.)+[a-z]{2,}"), 2) + if_(F.lower(rel).contains("external"), 1) + if_(target == "_blank", 1) + if_((label_of != "") & bare.contains(label_of), 4)
    return F.when((host == "") | host.contains(own) | urls.has_any(host, social), -1).otherwise(points)


def label_link_points(url: Column, label: Column, further: Column) -> Column:
    """Points of a directory's link: 2 if label or address has a host name, 1 if the label says
    website, 1 more for information where the page has a section of further information."""
    says = urls.has_any(F.lower(label), ["www", "website", "webseite", "homepage", "zur website", "mehr infos", "informationen"])
    if_ = lambda c, v: F.when(c, v).otherwise(0)
    return if_(F.concat_ws(" ", label, url).rlike(r"(?i)([a-z0-9-]+\.)+[a-z]{2,}"), 2) + if_(says, 1) + if_(further & label.rlike("(?i)information"), 1)


def cards(pages: DataFrame, key: str, html: str = "html", ignored: list[str] = IGNORED_HEADINGS) -> DataFrame:
    """(key, card, name, body): what follows each heading of level 2 to 4, up to the next one.
    Names have 2 to 200 characters and no ignored word."""
    parts = F.split(html, r"(?i)(?=<h[234]\b)")
    d = pages.select(key, F.posexplode(parts).alias("card", "body")).where(F.col("body").rlike(r"(?i)^<h[234]\b"))
    d = d.withColumn("name", page_heading(F.col("body"), "234"))
    return d.where((F.char_length("name") >= 2) & (F.char_length("name") <= 200) & ~urls.has_any(F.lower("name"), ignored)).select(key, "card", "name", "body")


def card_links(pages: DataFrame, key: str, own: str, html: str = "html") -> DataFrame:
    """(key, card, name, href, score): the best link of each card; cards without one are out."""
    c = cards(pages, key, html)
    a = anchor_details(c, [key, "card", "name"], "body").withColumn("href", urls.repair_scheme(F.col("href")))
    return best_link(a, [key, "card", "name"], card_link_points(F.col("href"), F.col("label"), F.col("rel"), F.col("target"), F.col("name"), own))


def json_ld(html: Column) -> Column:
    """name, url and telephone of the page's first JSON-LD object that has a type."""
    v = linked_data(html)
    return F.when(v.isNotNull(), F.struct(*(F.try_variant_get(v, f"$.{k}", "string").alias(k) for k in ("name", "url", "telephone"))))


def container_score(text: Column) -> Column:
    """How much a container looks like a list of members: bars, host names and anchors."""
    return F.regexp_count(text, F.lit(r" \| ")) + F.regexp_count(text, F.lit(r"www\.")) + F.regexp_count(text, F.lit("(?i)<a "))


def last_url(text: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(r"https?://[^\s<>\"')\]]+"), F.lit(0)), F.lit(-1))


def markdown_entities(lines: DataFrame, key: str = "doc", order: str = "ord", line: str = "line") -> DataFrame:
    """Bullets with a URL under their `##` heading: (key, ord, section, organisation, url)."""
    head = F.regexp_extract(line, r"^##+\s*(.+?)\s*$", 1)
    d = scan(lines, [key], [order], last={"section": F.nullif(head, F.lit(""))})
    url = F.regexp_extract(line, r"https?://[^\s)>\]]+", 0)
    name = F.regexp_extract(line, r"^\s*[-*]\s*\**(.+?)\**\s*(?:[:(\[–-]|https?://)", 1)
    d = d.withColumn("url", url).withColumn("organisation", F.trim(name))
    return d.where(F.col(line).rlike(r"^\s*[-*]") & (F.col("url") != "")).select(key, order, "section", "organisation", "url")


def blocks(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Blank-line separated blocks: (key, block, name, domain). The first line is the name;
    lines that begin with 'web page' give domains, one row each; blocks without one give a
    row with ''."""
    b = texts.select(key, F.posexplode(F.split(text, r"\n\s*\n")).alias("block", "b"))
    lines = F.filter(F.split("b", "\n"), lambda x: F.trim(x) != "")
    web = F.filter(lines, lambda x: F.lower(F.trim(x)).startswith("web page"))
    hosts = F.array_distinct(F.flatten(F.transform(web, lambda x: F.regexp_extract_all(F.lower(x), F.lit(r"(?:https?://)?(?:www\.)?([a-z0-9-]+(?:\.[a-z0-9-]+)+)"), F.lit(1)))))
    d = b.where(F.size(lines) > 0).select(key, "block", F.trim(F.get(lines, F.lit(0))).alias("name"), F.explode_outer(hosts).alias("domain"))
    return d.withColumn("domain", F.coalesce("domain", F.lit("")))


def flatten_xml(element, path: str = "", out: dict | None = None) -> dict[str, str]:
    """Leaf texts by path 'a.b', attributes as 'path@name', repeated keys with __2, __3 …"""
    out = {} if out is None else out

    def put(k: str, v: str) -> None:
        n, key = 1, k
        while key in out:
            n += 1
            key = f"{k}__{n}"
        out[key] = v

    for k, v in element.attrib.items():
        put(f"{path}@{k}" if path else f"@{k}", v)
    if len(element) == 0:
        if path and (element.text or "").strip():
            put(path, element.text.strip())
        return out
    for child in element:
        flatten_xml(child, f"{path}.{child.tag}" if path else child.tag, out)
    return out


def xml_records(records: DataFrame, xml: str = "xml") -> DataFrame:
    """records with `fields`: map<string,string> of each record's flattened element; null for
    what isn't well formed. One record a row, so memory is a record's."""

    def run(s: pd.Series) -> pd.Series:
        import xml.etree.ElementTree as E

        def one(x):
            try:
                return flatten_xml(E.fromstring(x)) if x else None
            except E.ParseError:
                return None

        return pd.Series([one(x) for x in s])

    return records.withColumn("fields", F.pandas_udf(run, "map<string,string>")(F.col(xml)))


def read_xml(spark: SparkSession, path: str, tag: str, schema=None) -> DataFrame:
    r = spark.read.format("xml").option("rowTag", tag)
    return (r.schema(schema) if schema else r).load(path)


def guess_record_tag(events: Iterator[tuple[str, int]], limit: int = 50_000) -> str | None:
    """events: (tag, number of children). The most frequent tag with children among the first
    limit, if it comes at least max(5, a tenth of the most frequent tag's) times."""
    from collections import Counter
    from itertools import islice

    every, parents = Counter(), Counter()
    for tag, n in islice(events, limit):
        every[tag] += 1
        parents[tag] += n > 0
    if not every or not any(parents.values()):
        return None
    tag, n = parents.most_common(1)[0]
    return tag if n >= max(5, every.most_common(1)[0][1] / 10) else None


def parsed_files(files: DataFrame, parse: Callable[[bytes], list[tuple[int, int, int, str]]]) -> DataFrame:
    """Cells (path, part, row, cell, text) of binary documents (workbooks, word-processor
    tables, page descriptions) by a given parser; the parsers need libraries that aren't
    part of Spark, so they are passed in. Files that a parser refuses have no cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, data in zip(b.path, b.content):
                try:
                    rows = parse(bytes(data))
                except Exception:  # noqa: BLE001  a parser may raise anything
                    rows = []
                yield pd.DataFrame([(path, *r) for r in rows], columns=["path", "part", "row", "cell", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, part int, row int, cell int, text string")


def bullets(lines: DataFrame, key: str, order: str = "ord", line: str = "line") -> DataFrame:
    """Wrapped bullet lines joined again: (key, item, text). A hyphen at a line's end joins
    without a blank."""
    d = scan(lines, [key], [order], total={"item": F.col(line).rlike(r"^\s*[•▪*-]\s").cast("int")}).where("item > 0")
    part = F.struct(F.col(order).alias("o"), F.trim(F.regexp_replace(F.col(line), r"^\s*[•▪*-]\s+", "")).alias("t"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["t"]), " ")
    return d.groupBy(key, "item").agg(F.regexp_replace(joined, r"(?<=\p{L})-\s(?=\p{Ll})", "").alias("text"))


# Words of headers and contacts, and words that only organisations' names have.
LIST_HEADERS = ["liste der umweltpartner", "stand:", "stand dezember", "hamburg.de"]
CONTACT_WORDS = ["www.", "http://", "https://", "@", "telefon", "fax", "tel.", "mail"]
ORGANISATION_WORDS = [
    "gmbh", "mbh", "kg", "co", "ag", "se", "ug", "eg", "ev", "e.v.", "mbb", "llp", "ltd", "inc", "stiftung", "verein", "partnerschaft", "partner",
    "rechtsanwälte", "rechtsanwaelte", "anwälte", "anwaelte", "gbr", "ohg", "kgaa",
]
PERSON_TITLES = ["prof.", "dr.", "prof", "dipl.-ing.", "ing.", "jr.", "sr."]
PERSON_HINTS = ["prof", "dr.", "dr ", "dipl.-", "ing.", "jr.", "sr.", "prof."]


def _capitals(s: Column, parts: str) -> tuple[Column, Column]:
    t = F.split(s, parts)
    return F.size(F.filter(t, lambda x: x.rlike(r"^\p{Lu}"))), F.size(F.filter(t, lambda x: x != ""))


def looks_like_name(s: Column) -> Column:
    """No header, contact or street, and a word of organisations' names or two capitals."""
    low = F.lower(F.coalesce(s, F.lit("")))
    street = low.rlike(r"(?U)\b(str\.|strasse|straße|weg|allee|platz|chaussee|damm|ring|ufer|markt)\b")
    t = F.split(s, r"[^A-Za-zÄÖÜäöüß0-9&+.-]+")
    capitals, _ = _capitals(s, r"[^A-Za-zÄÖÜäöüß0-9&+.-]+")
    out = (low != "") & ~urls.has_any(low, LIST_HEADERS + CONTACT_WORDS) & ~street & (urls.has_any(low, ORGANISATION_WORDS) | ((capitals >= 2) & (F.size(t) >= 2)))
    return F.coalesce(out, F.lit(False))


def looks_like_person(s: Column, strict: bool = True) -> Column:
    """A title, or capitals. strict: two to four of them and half of the words; else at least
    two among at most five words."""
    low = F.lower(F.trim(F.coalesce(s, F.lit(""))))
    capitals, n = _capitals(F.trim(F.coalesce(s, F.lit(""))), r"[^A-Za-zÄÖÜäöüß-]+")
    enough = (capitals >= 2) & (capitals <= 4) & (capitals >= F.greatest(F.lit(2), F.floor(n / 2))) if strict else (capitals >= 2) & (n <= 5)
    return urls.has_any(low, PERSON_TITLES if strict else PERSON_HINTS) | enough


# Headers of tables and the columns that they name.
HEADER_SYNONYMS = {
    "organization": ["organization", "organisation", "name", "entity", "actor", "company", "institution"],
    "contact_person": ["contact", "contact person", "contact name", "person", "ansprechpartner", "ansprechpartnerin"],
    "website_url": ["website", "webseite", "url", "link", "homepage", "web", "www"],
}


def table_entities(cells: DataFrame) -> DataFrame:
    """cells: (doc, part, section, row, cell, text), as a document's parser gives its tables.
    (doc, part, row, section, organization, contact_person, website_url) of the rows below
    each table's header, the first of every organisation and address of a document.

    The header is the first row that is half full; synonyms name its columns, the last of
    several. Without an organisation the longest cell that has no address stands in, else
    the address's host; the first cells that look so give address and person.
    """
    clean = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    line = F.transform(F.sort_array(F.collect_list(F.struct("cell", clean.alias("t")))), lambda x: x["t"])
    rows = cells.groupBy("doc", "part", "section", "row").agg(line.alias("c"))
    filled = F.size(F.filter("c", lambda x: x != ""))
    head = rows.groupBy("doc", "part").agg(F.coalesce(F.min(F.when(filled >= F.greatest(F.lit(1), F.floor(F.size("c") / 2)), F.col("row"))), F.min("row")).alias("head"))
    rows = rows.join(head, ["doc", "part"])
    norm = lambda x: F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9\s]", " "), r"\s+", " "))
    header = F.transform("c", norm)

    def column(kind: str) -> Column:
        return F.array_max(F.transform(header, lambda x, i: F.when(x.isin(HEADER_SYNONYMS[kind]), i))).alias(kind)

    d = rows.where("row > head").join(rows.where("row = head").select("doc", "part", F.struct(*map(column, HEADER_SYNONYMS)).alias("at")), ["doc", "part"])
    cell = lambda k: F.coalesce(F.get("c", F.col("at")[k].cast("int")), F.lit(""))
    found = F.get(F.filter(F.transform("c", urls.first_url), lambda u: u != ""), F.lit(0))
    url = F.coalesce(F.nullif(urls.first_url(cell("website_url")), F.lit("")), found, F.lit(""))
    plain = F.transform(F.filter("c", lambda x: (x != "") & ~x.rlike(r"https?://[^\s)]+")), lambda x, i: F.struct(F.char_length(x).alias("n"), (-i).alias("i"), x.alias("x")))
    host = F.replace(urls.domain(F.col("website_url")), F.lit("www."), F.lit(""))
    label = F.element_at(F.split(host, r"\."), F.when(F.size(F.split(host, r"\.")) >= 2, -2).otherwise(-1))
    guess = F.when(F.col("website_url") != "", F.concat(F.upper(F.substring(label, 1, 1)), F.lower(F.substring(label, 2, 1 << 30))))
    d = d.withColumn("website_url", url).withColumn("organization", F.coalesce(fallback_name(cell("organization"), F.array_max(plain)["x"], guess), F.lit("")))
    person = F.get(F.filter("c", lambda x: looks_like_person(x, False)), F.lit(0))
    d = d.withColumn("contact_person", F.coalesce(fallback_name(cell("contact_person"), person), F.lit("")))
    d = d.where((F.col("organization") != "") | (F.col("contact_person") != "") | (F.col("website_url") != ""))
    return keep(d, ["doc", "organization", "website_url"], ["part", "row"]).select("doc", "part", "row", "section", "organization", "contact_person", "website_url")
