"""Rule scores: relevance, links, locality, roles, tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..regions import Region
from .urls import has_any

# Place types that don't, and that always, belong to the ecosystem.
IRRELEVANT_TYPES = [
    "lodging", "hotel", "motel", "hostel", "resort", "restaurant", "cafe", "bar", "night_club", "bakery", "meal_delivery", "meal_takeaway", "food",
    "church", "mosque", "synagogue", "hindu_temple", "place_of_worship", "gym", "spa", "beauty_salon", "hair_care", "movie_theater", "casino",
    "bowling_alley", "amusement_park", "airport", "train_station", "bus_station", "transit_station", "laundry", "funeral_home", "cemetery",
    "clothing_store", "shoe_store", "jewelry_store",
]
RELEVANT_TYPES = ["university", "school", "library", "local_government_office", "city_hall", "courthouse", "bank", "finance", "accounting"]
# Substrings that raise or lower a score.
POSITIVE = [
    "recycl", "recycle", "recycling", "circular", "sustainability", "sustainable", "environment", "environmental", "eco", "green", "renewable", "solar", "wind", "energy",
    "waste", "reuse", "repair", "refurbish", "innovation", "research", "institute", "university", "startup", "incubator", "accelerator", "ngo", "foundation", "association",
    "recikla", "cirkularn", "održiv", "životna sredina", "ekološk", "zelena", "otpad", "ponovna upotreba", "popravka", "inovaci", "istraživanj", "institut", "univerzitet",
    "fakultet", "startup", "inkubator", "akcelerator", "udruženje", "fondacija", "organizacija",
]
NEGATIVE = [
    "hotel", "hostel", "motel", "resort", "restaurant", "restoran", "cafe", "kafić", "bar", "pub", "church", "crkva", "mosque", "džamija", "synagogue",
    "salon", "spa", "fitness", "gym", "teretana", "casino", "kladionica",
]
# Roles, and the substrings that name one, in order.
ROLES = [
    "Students", "Researchers", "Higher Education Institutions", "Research Institutes", "Non-Governmental Organizations", "Industry Partners", "Startups and Entrepreneurs",
    "Public Authorities", "Policy Makers", "End-Users", "Citizen Associations", "Media and Communication Partners", "Funding Bodies", "Knowledge and Innovation Communities",
]
ROLE_RULES = [
    ("student", 0), ("researcher", 1), ("higher education", 2), ("universit", 2), ("research institute", 3), ("non-governmental", 4), ("ngo", 4), ("industry", 5), ("partner", 5),
    ("startup", 6), ("entrepreneur", 6), ("public", 7), ("authorit", 7), ("policy", 8), ("end-user", 9), ("citizen", 10), ("media", 11), ("funding", 12), ("knowledge", 13), ("innovation", 13),
]


def types(s: Column) -> Column:
    """'A, b' as an array of trimmed, lower-cased types; [] for null and ''."""
    return F.when(F.coalesce(s, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.split(s, ","), lambda x: F.lower(F.trim(x)))))


def _any_of(a: Column, words: list[str]) -> Column:
    return F.arrays_overlap(a, F.array(*map(F.lit, words)))


def relevant_type(t: Column, always: list[str] = RELEVANT_TYPES, never: list[str] = IRRELEVANT_TYPES) -> Column:
    """Any type that always belongs keeps; else any that doesn't drops; else kept."""
    return F.when(_any_of(t, always), True).otherwise(~_any_of(t, never))


def relevance(name: Column, query: Column, t: Column, website: Column, rating: Column, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE, always: list[str] = RELEVANT_TYPES, never: list[str] = IRRELEVANT_TYPES) -> Column:
    """0 to 100, from 50: name and query keywords, place types, website and rating."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    if_ = lambda c, n: F.when(c, n).otherwise(0)
    score = (
        F.lit(50)
        + if_(has_any(low(name), positive), 10)
        + if_(has_any(low(query), positive), 5)
        + if_(_any_of(t, always), 15)
        - if_(has_any(low(name), negative), 20)
        - if_(_any_of(t, never), 25)
        + if_(F.coalesce(website, F.lit("")) != "", 5)
        + F.when(rating >= 4.5, 5).when(rating >= 4.0, 3).otherwise(0)
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), score)).cast("double")


def tier(kind: Column, score: Column) -> Column:
    """What becomes of a website candidate."""
    return F.when((kind == "directory") & (score >= 30), "directory").when((kind != "directory") & (score >= 70), "accepted").when((kind != "directory") & (score >= 40), "review-needed").otherwise("not-found")


def locality(text: Column, r: Region) -> Column:
    """Share of postal code, place name and phone that a text has for a region."""
    low = F.lower(F.coalesce(text, F.lit("")))
    own = F.coalesce(text, F.lit("")) if r.postal.startswith("MD") else low
    hits = [own.rlike(r.postal), has_any(low, list(r.names)), low.rlike("|".join(r.phones))]
    return sum((h.cast("int") for h in hits[1:]), hits[0].cast("int")) / F.lit(3.0)


def boost(based: Column, confidence: Column, score: Column) -> tuple[Column, Column]:
    """(based, confidence) raised by a locality score where they are weak."""
    weak = (confidence < 0.6) | ~based
    best = F.when(weak, F.greatest(confidence, score)).otherwise(confidence)
    return based | (weak & (best >= 0.6)), best


def role(s: Column, default: str = ROLES[5]) -> Column:
    """A role by its name in any case, else by the first rule whose substring occurs."""
    low = F.lower(F.trim(F.coalesce(s, F.lit(""))))
    exact = [F.when(low == r.lower(), r) for r in ROLES]
    rules = [F.when(low.contains(w), ROLES[k]) for w, k in ROLE_RULES]
    return F.coalesce(*exact, *rules, F.lit(default))


def severity(s: Column) -> tuple[Column, Column]:
    """(confidence, priority) of a gap."""
    return F.when(s == "critical", 0.85).when(s == "significant", 0.75).otherwise(0.65), F.when(s == "critical", "high").when(s == "significant", "medium").otherwise("low")


def domain_match(name_tokens: Column, host: Column) -> Column:
    """5 for each token inside the left-most label, and 2 if it has the initials."""
    label = F.split_part(host, F.lit("."), F.lit(1))
    hits = F.size(F.filter(name_tokens, lambda t: label.contains(t)))
    initials = F.array_join(F.transform(name_tokens, lambda t: F.substring(t, 1, 1)), "")
    return 5 * hits + F.when((F.char_length(initials) > 1) & label.contains(initials), 2).otherwise(0)


def item_match(query: Column, name: Column, description: Column, least: float = 0.7) -> Column:
    """1 for the same name, 0.85 for a substring of name or description, else the Jaccard of
    the query's words and those of name and description where it is `least` or more, else 0.
    Case makes no difference."""
    from .text import blank_words, jaccard

    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    q, n, d = low(query), low(name), low(description)
    j = jaccard(F.array_distinct(blank_words(query)), F.array_distinct(F.concat(blank_words(name), blank_words(description))))
    return F.when(n.contains(q) | d.contains(q), F.when(n == q, 1.0).otherwise(0.85)).when(j >= least, j).otherwise(0.0)


def items_match(query: Column, items: Column, name: str = "name", description: str = "description", least: float = 0.7) -> Column:
    """Struct of score, the best of an array of items (0 for none), and matched, the names of
    the items that score above 0, in order."""
    scored = F.transform(items, lambda x: F.struct(x[name].alias("name"), item_match(query, x[name], x[description], least).alias("score")))

    def told(every: Column) -> Column:
        best = F.coalesce(F.array_max(F.transform(every, lambda x: x["score"])), F.lit(0.0))
        matched = F.transform(F.filter(every, lambda x: x["score"] > 0), lambda x: x["name"])
        return F.struct(best.alias("score"), F.coalesce(matched, F.array().cast("array<string>")).alias("matched"))

    return F.transform(F.array(scored), told)[0]  # a lambda's argument is worked out once, a column where it is named


def recommendation(priority: Column, action: Column) -> tuple[Column, Column]:
    """(confidence, title) of a recommendation."""
    p = F.lower(F.coalesce(priority, F.lit("")))
    return F.when(p == "high", 0.8).when(p == "medium", 0.7).otherwise(0.6), F.concat(F.lit("["), F.upper(priority), F.lit("] "), F.substring(action, 1, 60))


def retry_status(confidence: Column) -> Column:
    return F.when(confidence == 0, "minimal_profile").when(confidence.isNotNull(), "success").otherwise("still_failed")
