"""Rows of organisations: places, verification, discovered entities, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores, text, urls
from ..regions import Region


def place_row(p: Column, role: Column, query: Column, at: Column | None = None) -> list[Column]:
    """The fourteen columns of a place struct: address falls back to the vicinity, types to the
    one type; what a place lacks is ''."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kinds = F.when(F.size(F.coalesce(p["types"], F.array().cast("array<string>"))) > 0, p["types"]).otherwise(F.filter(F.array(p["type"]), lambda t: F.coalesce(t, F.lit("")) != ""))
    return [
        blank(p["name"]).alias("name"), blank(F.coalesce(p["formatted_address"], p["vicinity"])).alias("address"), blank(p["formatted_phone_number"]).alias("phone"), blank(p["website"]).alias("website"),
        blank(p["geometry"]["location"]["lat"]).alias("latitude"), blank(p["geometry"]["location"]["lng"]).alias("longitude"), blank(p["place_id"]).alias("google_place_id"),
        F.array_join(kinds, ", ").alias("place_types"), blank(p["business_status"]).alias("business_status"), blank(p["rating"]).alias("rating"), blank(p["user_ratings_total"]).alias("user_ratings_total"),
        role.alias("ecosystem_role"), query.alias("search_query"), text.stamp(at).alias("timestamp"),
    ]


# Fixed value: the address that stands for none in the directory's rows.
NO_WEBSITE = ["https://www.koeln.de/"]


def blank_placeholders(c: Column, addresses: list[str] = NO_WEBSITE) -> Column:
    """'' where a value is, trimmed and in any case, an address that stands for none; others,
    null too, and all rows stay."""
    return F.when(F.lower(F.trim(c)).isin(addresses), F.lit("")).otherwise(c)


def mentions(columns: list[Column], patterns: list[str]) -> Column:
    """Whether any of some patterns, in any case, occurs in the columns together."""
    whole = F.lower(F.concat_ws(" ", *columns))
    return (F.trim(whole) != "") & whole.rlike("|".join(f"(?:{p.lower()})" for p in patterns))


# Patterns of affiliations with the city of the first region.
AFFILIATION = [
    r"\bhamburg\b", r"\bhamburg[-\s]?harburg\b", r"\buniversit[aä]t hamburg\b|\buniversity of hamburg\b|\buhh\b", r"\btechnische universität hamburg\b|\btechnical university of hamburg\b|\btuhh\b",
    r"\bhamburg university of applied sciences\b|\bhaw hamburg\b", r"\bhelmholtz (center|zentrum).{0,30}hamburg\b", r"\bdesy\b|\bdeutsches elektronen[-\s]?synchrotron\b", r"\bmax[-\s]?planck.{0,30}hamburg\b",
    r"\buke\b|\b(universit[aä]ts)?klinikum hamburg[-\s]?eppendorf\b", r"\bhafencity university\b|\bhafencity universit[aä]t\b|\bhcu\b", r"\bhelmut schmidt university\b|\buniversit[aä]t der bundeswehr hamburg\b|\bhsu\b", r"\bhamburg school of business administration\b|\bhsba\b",
]


def verify(df: DataFrame, page: str, region: Region, keywords: list[str] = scores.POSITIVE) -> DataFrame:
    """df with is_region_based, region_confidence, is_relevant, relevance and should_extract,
    by rule: locality of the text, and a confidence that grows with the keywords found."""
    low = F.lower(F.coalesce(F.col(page), F.lit("")))
    place = scores.locality(F.col(page), region)
    hits = sum(low.contains(k).cast("int") for k in keywords)
    d = df.withColumn("region_confidence", F.when(place > 0, F.greatest(F.lit(0.6), place)).otherwise(0.0)).withColumn("relevance", F.least(F.lit(1.0), hits / F.lit(5.0)))
    d = d.withColumn("is_region_based", F.col("region_confidence") >= 0.6).withColumn("is_relevant", F.col("relevance") >= 0.4)
    return d.withColumn("should_extract", F.col("is_region_based") & F.col("is_relevant"))


def split_discovered(entities: Column, fields: tuple[str, ...] = ("name", "url", "brief_description", "context")) -> tuple[Column, Column]:
    """(valid, rejected) of an array of structs: a valid one has all fields, none blank; a
    rejected one stands with its index and the reason, nulls before blanks."""

    def lacking(x: Column, test) -> Column:
        return F.filter(F.array(*(F.when(test(x[f]), F.lit(f)) for f in fields)), lambda f: f.isNotNull())

    nulls = lambda x: lacking(x, lambda v: v.isNull())
    blanks = lambda x: lacking(x, lambda v: F.trim(F.coalesce(v, F.lit(""))) == "")

    def reason(x: Column) -> Column:
        return F.when(F.size(nulls(x)) > 0, F.concat(F.lit("None/null values in fields: "), F.array_join(nulls(x), ", "))).otherwise(F.concat(F.lit("Empty string in fields: "), F.array_join(blanks(x), ", ")))

    told = F.transform(entities, lambda x, i: F.struct(i.alias("index"), F.when(F.size(blanks(x)) > 0, reason(x)).alias("reason"), x.alias("entity")))
    return F.filter(entities, lambda x: F.size(blanks(x)) == 0), F.filter(told, lambda t: t["reason"].isNotNull())


def with_minimal(todo: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Every row of todo with its profile, or a minimal one of confidence 0 named by its host."""
    met = todo.select(key).join(done, key, "left")
    return met.withColumn("status", scores.retry_status(F.col("confidence"))).withColumn("name", F.coalesce("name", urls.display_name(F.col(key)))).withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


# Hosts that are nobody's own, and parts of addresses of listings and news.
SOCIAL_HOSTS = ["facebook.com", "instagram.com", "linkedin.com", "twitter.com", "x.com", "youtube.com", "youtu.be", "t.me", "tiktok.com", "vk.com", "ok.ru"]
BLOCKED_HOSTS = ["stackoverflow.com", "stackexchange.com", "canva.com", "play.google.com", "apps.apple.com", "support.google.com", "microsoft.com"]
LISTING_PARTS = ["facebook.com", "/news/", "/stiri/", "/articles/", "/item/"]
REJECTED = -100


def candidate_points(url: Column, title: Column, body: Column, name_tokens: Column, place: str, tld: str, rejects: list[str] = [*SOCIAL_HOSTS, *BLOCKED_HOSTS], listings: list[str] = LISTING_PARTS) -> Column:
    """Points of a website candidate: its country's domain 20, 15 for each of two name words in
    title or text, name words in the host 25, the place in the text 10, a listing or news
    address -15. Title and text are compared without marks. Without a host, or at a host
    that is rejected, -100 and nothing else."""
    plain = lambda c: text.strip_marks(F.lower(F.coalesce(c, F.lit(""))))
    if_ = lambda c, v: F.when(c, v).otherwise(0)
    host, t, b = urls.domain(F.coalesce(url, F.lit(""))), plain(title), plain(body)
    n = F.size(F.filter(name_tokens, lambda w: t.contains(w) | b.contains(w)))
    bare = F.split_part(host, F.lit(":"), F.lit(1))
    points = if_(host.endswith(tld), 20) + 15 * F.least(n, F.lit(2)) + if_(F.exists(name_tokens, lambda w: bare.contains(w)), 25) + if_(b.contains(place), 10) - if_(urls.has_any(F.lower(url), listings), 15)
    return F.when((host == "") | urls.has_any(host, rejects), REJECTED).otherwise(points)


def page_points(html: Column, title: Column, heading: Column, body: Column, name_tokens: Column, place: str) -> Column:
    """Points of a page: 20 for each of two name words in title or heading, 15 for the place in
    the text, less 5 for a title of under four characters as it stands; 0 without a page."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    t, h = low(title), low(heading)
    n = F.size(F.filter(name_tokens, lambda w: t.contains(w) | h.contains(w)))
    points = 20 * F.least(n, F.lit(2)) + F.when(low(body).contains(place), 15).otherwise(0) - F.when(F.char_length(t) < 4, 5).otherwise(0)
    return F.when(F.coalesce(html, F.lit("")) == "", 0).otherwise(points)


def until_repeat(pages: DataFrame, key: str, order: str, signature: str) -> DataFrame:
    """Pages of each list up to the first whose signature came before: where paging stops."""
    seen = F.row_number().over(Window.partitionBy(key, signature).orderBy(order)) > 1
    stop = F.min(F.when(F.col("__seen"), F.col(order))).over(Window.partitionBy(key))
    d = pages.withColumn("__seen", seen).withColumn("__stop", stop)
    return d.where(F.col("__stop").isNull() | (F.col(order) < F.col("__stop"))).drop("__seen", "__stop")


# Legal phrases, the longest first, and patterns of legal forms.
LEGAL_PHRASES = [
    "societatea cu răspundere limitată", "societatea cu raspundere limitata", "societate cu răspundere limitată", "societate cu raspundere limitata",
    "cu răspundere limitată", "cu raspundere limitata", "întreprinderea municipală", "intreprinderea municipala", "întreprinderea individuală",
    "intreprinderea individuala", "întreprinzător individual", "intreprinzator individual", "asociația proprietarilor", "asociatia proprietarilor",
    "societatea comercială", "societatea comerciala", "societatea pe acțiuni", "societatea pe actiuni", "cooperativa de consum", "gospodăria țărănească",
    "gospodaria taraneasca", "întreprinderea", "intreprinderea", "pe acțiuni", "pe actiuni", "comercială", "comerciala", "societatea", "societate",
    "compania", "î.i.", "i.i.",
]
LEGAL_FORMS = [
    r"\bSRL\b", r"\bS\.R\.L\b", r"\bSA\b", r"\bS\.A\b", r"\bÎI\b", r"\bII\b", r"\bÎ\.I\b", r"\bAO\b", r"\bONG\b", r"\bIM\b", r"\bÎ\.M\b", r"\bIP\b",
    r"\bInstitut(ul|ia)?\b", r"\bAgenția\b", r"\bCompania\b", r"\bSocietatea\b", r"\bGrupul\b",
]
# Kinds of small businesses that are left out, without marks.
SKIPPED_KINDS = [
    "intreprindere individuala", "intreprinderea individuala", "intreprinzator individual", "intreprinzatorul individual", "gospodaria taraneasca",
    "gospodarie", "asociatia proprietarilor", "asociatie proprietari",
]


def agency_name(s: Column, phrases: list[str] = LEGAL_PHRASES, forms: list[str] = LEGAL_FORMS) -> Column:
    """A name in lower case without marks, legal phrases in their order, legal forms, quotes
    and punctuation. Marks go first, so phrases and forms with marks never match."""
    t = F.lower(text.strip_marks(F.coalesce(s, F.lit(""))))
    t = F.aggregate(F.array(*map(F.lit, phrases or [""])), t, lambda a, p: F.when(p == "", a).otherwise(F.replace(a, p, F.lit(" "))))
    if forms:
        t = F.regexp_replace(t, "(?iu)" + "|".join(f"(?:{x})" for x in forms), " ")
    return text.squeeze(F.regexp_replace(F.regexp_replace(t, "[\"'`“”„«»]+", " "), r"(?U)[^\w\s-]", " "))


def skipped_kind(cells: list[Column], phrases: list[str] = SKIPPED_KINDS) -> Column:
    """Whether any phrase occurs in the cells together, in lower case and without marks."""
    return urls.has_any(text.strip_marks(F.lower(F.concat_ws(" ", *cells))), phrases)


def noisy_member(name: Column, url: Column, own: str) -> Column:
    """Whether a listed member is noise: no host or the list's own, or a name that is an
    e-mail address, says e-mail or has a phone number."""
    host = urls.domain(url, "strip")
    return (host == "") | host.endswith(own) | name.contains("@") | F.lower(name).contains("email") | name.rlike(r"\b\+?\d[\d\s()./-]{5,}")
