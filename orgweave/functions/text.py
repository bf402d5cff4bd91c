"""Text expressions: names, phones, tokens, titles. All are Column -> Column."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes, in the order in which they are taken off.
LEGAL_SUFFIXES = [
    "gmbh", "e.v.", "ag", "kg", "ohg", "gbr", "ug", "mbh", "e.g.", "d.o.o.", "a.d.", "d.d.", "j.p.", "z.u.", "s.r.l.", "s.a.", "i.i.", "s.c.", "p.f.a.",
    "ltd", "ltd.", "inc", "inc.", "llc", "corp", "corp.", "co.", "plc", "& co", "& co.", "und co", "& cie",
]

# Words dropped from the names of research organisations.
OPEN_STOPLIST = ["university", "universitaet", "universität", "universitat", "hochschule", "gmbh", "ag", "ggmbh", "ev", "institute", "institut", "college", "school", "center", "centre"]

# Words that don't tell agencies apart.
AGENCY_STOPLIST = ["compania", "grupul", "agentia", "institutul", "national", "centrul", "unitatea"]



def _marked() -> tuple[str, str]:
    """Letters of the Latin, Greek and Cyrillic blocks with a mark, and what is left without."""
    import unicodedata

    pairs = {}
    for c in map(chr, range(0xC0, 0x530)):
        plain = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if plain != c and len(plain) == 1:
            pairs[c] = plain
    return "".join(pairs), "".join(pairs.values())


MARKED, PLAIN = _marked()


def squeeze(s: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(s, r"(?U)\s+", " "))


def category(s: Column, default: str) -> Column:
    """Words capitalised, the rest lower; blank or null gives the default."""
    t = F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), r"\s+", " "))
    return F.when(t == "", F.lit(default)).otherwise(F.initcap(t))


def title(s: Column) -> Column:
    """Upper case after anything that isn't a letter, lower case elsewhere."""
    parts = F.split(F.lower(s), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))), "")


def source_category(default: Column, custom: Column) -> Column:
    """default, followed by the titled custom category where there is one."""
    c = F.trim(F.coalesce(custom, F.lit("")))
    return F.when(c == "", default).otherwise(F.concat(default, F.lit(" - "), title(c)))


def legal_name(s: Column) -> Column:
    """A name without legal forms. For each suffix in order: taken off the end, then
    ' suffix' is taken out wherever it stands, also before further letters."""
    t = F.trim(F.lower(F.coalesce(s, F.lit(""))))

    def off(t: Column, x: Column) -> Column:
        cut = F.when(F.endswith(t, x), F.trim(F.substring(t, F.lit(1), F.char_length(t) - F.char_length(x)))).otherwise(t)
        return F.replace(cut, F.concat(F.lit(" "), x), F.lit(""))

    return squeeze(F.aggregate(F.array(*map(F.lit, LEGAL_SUFFIXES)), t, off))


def open_name(s: Column) -> Column:
    """Lower case, ASCII letters and digits only, without the words of OPEN_STOPLIST."""
    t = F.regexp_replace(F.trim(F.lower(F.coalesce(s, F.lit("")))), "[^a-z0-9]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, rf"\b(?:{'|'.join(OPEN_STOPLIST)}|e v)\b", " "), r"\s+", " "))


def strip_marks(s: Column) -> Column:
    """Letters without their diacritical marks, by a table; letters like ø and ł stay."""
    return F.translate(s, MARKED, PLAIN)


def without_legal_form(s: Column) -> Column:
    """A name without legal forms as whole words, in any case."""
    return squeeze(F.regexp_replace(s, r"(?i)\b(?:gmbh|mbh|ag|kg|ohg|gbr|ug|e\.\s?v|se|ltd|inc|llc)\b\.?", " "))


def phone(s: Column) -> Column:
    """Digits without the first of the prefixes 49, 381, 373 and 40 that they start with."""
    d = F.regexp_replace(F.coalesce(s, F.lit("")), "[^0-9]", "")
    rest = lambda n: F.substring(d, n + 1, 1 << 30)
    return F.when(d.startswith("49"), rest(2)).when(d.startswith("381"), rest(3)).when(d.startswith("373"), rest(3)).when(d.startswith("40"), rest(2)).otherwise(d)


def tokens(s: Column, pattern: str = r"(?U)\W+", least: int = 3, stop: list[str] | None = None) -> Column:
    """Lower-cased parts between pattern, at least `least` long and not in stop."""
    parts = F.split(F.lower(F.coalesce(s, F.lit(""))), pattern)
    ok = lambda t: (F.char_length(t) >= least) & (~t.isin(stop) if stop else F.lit(True))
    return F.filter(parts, ok)


def blank_words(s: Column) -> Column:
    """Lower-cased words between white space."""
    return F.filter(F.split(F.lower(F.coalesce(s, F.lit(""))), r"(?U)\s+"), lambda t: t != "")


def doi(s: Column) -> Column:
    return F.replace(F.lower(F.trim(s)), F.lit("https://doi.org/"), F.lit(""))


def repair_encoding(s: Column) -> Column:
    """UTF-8 that was read as Latin-1 put right; anything else unchanged."""
    latin = F.when(s.rlike(r"^[\x00-\xFF]*$"), F.encode(s, "ISO-8859-1").cast("string"))
    return F.coalesce(F.try_validate_utf8(latin), s)


def drop_count(s: Column) -> Column:
    """A trailing number after a blank goes."""
    return F.regexp_replace(F.trim(s), r"\s+\d+$", "")


def drop_numbering(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s*\d+[.)]\s*", "")


def entry_name(s: Column) -> Column:
    """The name of a list entry: what stands before 'pagina web:', and of that what is quoted."""
    head = F.trim(F.get(F.split(s, r"(?i)pagina\s*web\s*: ?"), F.lit(0)))
    quoted = F.trim(F.regexp_extract(head, "[\"“„]([^\"”]+)[\"”]", 1))
    return F.when(quoted != "", quoted).otherwise(head)


def short_name(s: Column) -> Column:
    """What stands before two blanks, a bar or a comma."""
    return F.trim(F.regexp_extract(s, r"^(.*?)(?:\s{2,}|\||,|$)", 1))


def share(v: Column) -> Column:
    """A confidence over 1 is a percentage."""
    return F.when(v > 1, v / 100).otherwise(v)


def jaccard(a: Column, b: Column) -> Column:
    """Of the distinct elements of two arrays; 0 if either is empty."""
    n = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / n)


def overlap(a: Column, b: Column, by: str = "least") -> Column:
    """Common elements by the smaller (least) or the larger (greatest) set's size."""
    x, y = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    return F.try_divide(F.size(F.array_intersect(a, b)), getattr(F, by)(x, y))


def place_query(address: Column, suffix: str) -> Column:
    """An address with the city's suffix, unless it has it already in any case."""
    return F.when(F.lower(address).contains(suffix.lower()), address).otherwise(F.concat(address, F.lit(suffix)))


def stamp(at: Column | None = None, form: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    """A time, now if none is given, as ISO text; 'yyyyMMdd_HHmmss' gives the form of file names."""
    return F.date_format(F.current_timestamp() if at is None else at, form)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two strings, as Python's difflib has it; not symmetric.

    Rows go to Python in Arrow batches. Filter by length first: the ratio can't exceed
    2 * min / (len a + len b).
    """

    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([None if p is None or q is None else SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)], dtype=float)

    return F.pandas_udf(ratio, "double")(a, b)


def ratio_bound(a: Column, b: Column) -> Column:
    x, y = F.char_length(a), F.char_length(b)
    return F.try_divide(2 * F.least(x, y), x + y)
