"""URL expressions. They follow RFC 3986's split, so ports and odd hosts are kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import title

SPLIT = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"
# What stands for no address.
PLACEHOLDERS = ["n/a", "none", "null", "-"]
# Hosts that aren't an organisation's own.
SOCIAL = ["facebook.com", "instagram.com", "linkedin.com", "twitter.com", "x.com", "youtube.com", "tiktok.com", "t.me"]


def part(u: Column, k: int) -> Column:
    """1 scheme, 2 authority, 3 path; '' where the URL has no scheme."""
    return F.regexp_extract(F.coalesce(u, F.lit("")), SPLIT, k)


def clean(u: Column) -> Column:
    """Trimmed, without one trailing slash."""
    return F.regexp_replace(F.trim(u), "/$", "")


def is_valid(u: Column) -> Column:
    return F.coalesce(F.trim(u).rlike("^https?://"), F.lit(False))


def normalize(u: Column, add_protocol: bool = False, extra: tuple[str, ...] = ()) -> Column:
    """scheme://host/path without query, fragment and last segment's parameters, and
    without one trailing slash unless the path is just that; '' if it isn't http."""
    t = F.trim(F.coalesce(u, F.lit("")))
    t = F.when(F.lower(t).isin([*PLACEHOLDERS, *extra, ""]), F.lit("")).otherwise(t)
    if add_protocol:
        t = F.when((t != "") & ~F.lower(t).rlike("^https?://"), F.concat(F.lit("https://"), t)).otherwise(t)
    path = F.regexp_replace(part(t, 3), ";[^/]*$", "")
    path = F.when((path != "/") & path.endswith("/"), F.regexp_replace(path, "/$", "")).otherwise(path)
    whole = F.concat(F.lower(part(t, 1)), F.lit("://"), part(t, 2), path)
    return F.when(F.lower(part(t, 1)).isin("http", "https") & (part(t, 2) != ""), whole).otherwise("")


def match_key(u: Column) -> Column:
    """scheme://host in lower case, and the path without trailing slashes."""
    bare = F.regexp_extract(F.coalesce(u, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.concat(F.lower(part(u, 1)), F.lit("://"), F.lower(part(u, 2)), F.regexp_replace(bare, "/+$", ""))


def domain(u: Column, www: str = "keep") -> Column:
    """Authority in lower case. www: keep it, strip it in front, or remove it anywhere."""
    h = F.lower(part(u, 2))
    return {"keep": h, "strip": F.regexp_replace(h, r"^www\.", ""), "remove": F.replace(h, F.lit("www."), F.lit(""))}[www]


def repair_scheme(u: Column) -> Column:
    """One scheme: repeated ones collapse, //x and bare names get https."""
    t = F.regexp_replace(F.trim(u), r"^(?:https?:/*)+(https?://)", "$1")
    return F.when(t.startswith("//"), F.concat(F.lit("https:"), t)).when(t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), t))


def without_trackers(u: Column) -> Column:
    """No utm_*, gclid and fbclid parameters, with the sign before them and up to the next one;
    a ? that then meets a & stays alone, and none of either hangs at the end."""
    t = F.regexp_replace(u, r"[?&](?:utm_[^=&]+|gclid|fbclid)=[^&]*", "")
    return F.regexp_replace(F.replace(t, F.lit("?&"), F.lit("?")), r"[?&]+$", "")


def document_url(u: Column) -> Column:
    """An address as documents have it: no punctuation around it, no numbers of notes behind
    it, https where the scheme is missing, no trackers; '' for null and blank."""
    t = F.regexp_replace(F.regexp_replace(F.trim(u), r"^[).,;]+|[).,;]+$", ""), r"\s+\d+(?:\s+\d+)*$", "")
    t = F.when(t.rlike("^https?://"), t).otherwise(F.concat(F.lit("https://"), t))
    return F.when(F.trim(F.coalesce(u, F.lit(""))) == "", F.lit("")).otherwise(without_trackers(t))


def first_url(s: Column) -> Column:
    """The first address, else the first host name, of a text, as document_url has it; or ''."""
    whole, host = F.regexp_extract(F.coalesce(s, F.lit("")), r"(https?://[^\s)]+)", 1), F.regexp_extract(F.coalesce(s, F.lit("")), r"(?i)\b(?:[a-z0-9][a-z0-9.-]*\.[a-z]{2,})(?:/[^\s]*)?", 0)
    return document_url(F.when(whole != "", whole).otherwise(host))


def unwrap(u: Column, names: tuple[str, ...] = ("url", "dest", "destination", "to", "link", "u")) -> Column:
    """The target of a redirect: the first such parameter that decodes to http, else the URL."""
    got = [F.try_url_decode(F.regexp_extract(u, rf"[?&]{n}=([^&#]*)", 1)) for n in names]
    return F.coalesce(*(F.when(g.startswith("http"), g) for g in got), u)


def has_any(text: Column, words: list[str]) -> Column:
    """Whether text contains any of some substrings."""
    return reduce(lambda a, w: a | text.contains(w), words, F.lit(False))


def hostname(u: Column) -> Column:
    """Host in lower case, without user and port."""
    return F.regexp_replace(F.regexp_replace(F.lower(part(u, 2)), "^.*@", ""), ":[0-9]*$", "")


def organisation(u: Column, known: dict[str, str]) -> Column:
    """An organisation's name from its host: known hosts, the first known host that it ends
    with, else the capitalised label before the last one. known is a small parameter, so it
    is written into the plan."""
    h = domain(u, "strip")
    label = F.element_at(F.split(h, r"\."), F.when(F.size(F.split(h, r"\.")) >= 2, -2).otherwise(-1))
    exact = [F.when(h == k, v) for k, v in known.items()]
    ends = [F.when(h.endswith(k), v) for k, v in known.items()]
    capital = F.concat(F.upper(F.substring(label, 1, 1)), F.lower(F.substring(label, 2, 1 << 30)))
    return F.coalesce(*exact, *ends, capital)


def display_name(u: Column) -> Column:
    """First label of the host, hyphens as blanks, in title case."""
    return title(F.replace(F.split_part(domain(u, "strip"), F.lit("."), F.lit(1)), F.lit("-"), F.lit(" ")))
