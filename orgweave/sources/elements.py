"""Page structure as a table: an element a row, with its place in the tree.

An element's descendants have the numbers after its own up to `last`, and it stands among
their `ancestors`; so what is inside a card, which picture a link holds and which heading
comes before are joins and windows over a page's rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..operators.dedupe import keep
from ..operators.hot import by_shuffle
from ..scratch import written
from .markup import card_link_points, fallback_name

ROWS = 4096
#: Elements without content, and which open ones a start tag ends, up to a scope.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "a": {"a"}} | {b: {"p"} for b in BLOCKS}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "a": {"table"}}
_SCOPE = {"table", "td", "th", "button", "object"}
HIDDEN = {"script", "style", "template", "noscript"}
TEXT = "#text"
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class _Tree(HTMLParser):
    """Rows (pre, post, last, parent, depth, ancestors, tag, attributes, text) of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.closed = 0

    def _add(self, tag: str, attrs: dict | None, text: str | None) -> int:
        k = len(self.rows)
        self.rows.append([k, 0, k, self.open[-1] if self.open else None, len(self.open), list(self.open), tag, attrs, text])
        return k

    def _close(self) -> None:
        row = self.rows[self.open.pop()]
        row[1], row[2] = self.closed, len(self.rows) - 1
        self.closed += 1

    def handle_starttag(self, tag, attrs):
        ended, scope = ENDS.get(tag, ()), SCOPES.get(tag, _SCOPE)
        if ended:
            for at in range(len(self.open) - 1, -1, -1):
                name = self.rows[self.open[at]][6]
                if name in ended:
                    while len(self.open) > at:
                        self._close()
                elif name in scope:
                    break
        first: dict[str, str] = {}
        for k, v in attrs:
            first.setdefault(k, v or "")
        self.open.append(self._add(tag, first, None))
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash ends only elements without content

    def handle_endtag(self, tag):
        if any(self.rows[k][6] == tag for k in self.open):
            while self.rows[self.open[-1]][6] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        if data.strip() and not (self.open and self.rows[self.open[-1]][6] in HIDDEN):
            row = self.rows[self._add(TEXT, None, " ".join(data.split()))]
            row[1] = self.closed
            self.closed += 1

    def read(self, html: str) -> list[list]:
        self.feed(html)
        self.close()
        while self.open:
            self._close()
        return self.rows


def elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, pre, post, last, parent, depth, ancestors, tag, attrs, text) of the elements of pages.

    pre numbers elements as they begin, post as they end, last is the pre of the last one
    inside; ancestors lists the pre of all that an element is in, outermost first. Runs of
    text are rows with tag #text, white space squeezed; those of scripts and styles and
    comments are left out. Unclosed elements end where HTML ends them, or with their parent.
    Null and empty pages have no rows. A page is one task's work. The table is written, as its
    readers join it with itself.
    """
    kind = pages.schema[key].dataType
    schema = f"`{key}` {kind.simpleString()}, pre int, post int, last int, parent int, depth int, ancestors array<int>, tag string, attrs map<string,string>, text string"
    kinds = [pa.int32()] * 5 + [pa.list_(pa.int32()), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
    names = [key, "pre", "post", "last", "parent", "depth", "ancestors", "tag", "attrs", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(b.column(1)):
                rows = _Tree().read(x.as_py()) if x.is_valid else []
                for at in range(0, len(rows), ROWS):
                    part = rows[at : at + ROWS]
                    columns = [[r[k] if k != 7 or r[k] is None else list(r[k].items()) for r in part] for k in range(9)]
                    own = b.column(0).take(pa.array([i] * len(part)))
                    yield pa.RecordBatch.from_arrays([own, *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    return written(pages.select(key, html).mapInArrow(run, schema))


def inside(inner: DataFrame, outer: DataFrame, key: str, nearest: bool = True) -> DataFrame:
    """inner's rows with `within`, the pre of the element of outer that they are in: the nearest
    one, or a row for each."""
    each = inner.select(key, "pre", F.explode("ancestors").alias("within"))
    met = each.join(by_shuffle(outer.select(key, F.col("pre").alias("within"))), [key, "within"])
    if nearest:
        met = met.groupBy(key, "pre").agg(F.max("within").alias("within"))
    return inner.join(by_shuffle(met), [key, "pre"])


def inner_text(e: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """(key, pre, text, alt, has_image) of elements: the text inside, in order and parted by
    blanks, '' for none; the first alternative text or title of an image inside."""
    image = F.col("tag") == "img"
    alt = fallback_name(_attr("alt"), _attr("title"))
    part = e.where((F.col("tag") == TEXT) | image).select(key, "ancestors", "pre", F.struct("pre", "text").alias("t"), F.when(image, F.struct("pre", alt.alias("alt"))).alias("i"))
    met = inside(part, of, key, nearest=False)
    words = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("i").isNull(), F.col("t")))), lambda t: t["text"]), " ")
    found = met.groupBy(key, F.col("within").alias("pre")).agg(words.alias("text"), F.min("i").alias("i"))
    every = of.select(key, "pre").join(by_shuffle(found), [key, "pre"], "left")
    return every.select(key, "pre", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("i.alt", F.lit("")).alias("alt"), F.col("i").isNotNull().alias("has_image"))


def _attr(name: str) -> Column:
    return F.coalesce(F.trim(F.try_element_at("attrs", F.lit(name))), F.lit(""))


def has_class(*names: str) -> Column:
    """Whether an element has one of some classes."""
    return F.arrays_overlap(F.split(F.lower(_attr("class")), r"\s+"), F.array(*map(F.lit, names)))


def links(e: DataFrame, key: str, levels: tuple[str, ...] = HEADINGS) -> DataFrame:
    """(key, pre, ancestors, href, label, title, aria, alt, has_image, target, rel, heading) of the
    anchors: alt of the image inside the link, heading the nearest before it on the page."""
    a = e.where("tag = 'a'")
    head = e.where(F.col("tag").isin(*levels))
    text = inner_text(e, a.select(key, "pre").unionByName(head.select(key, "pre")), key)
    d = e.where((F.col("tag") == "a") | F.col("tag").isin(*levels)).drop("text").join(by_shuffle(text), [key, "pre"])
    before = F.last(F.when(F.col("tag") != "a", F.col("text")), ignorenulls=True).over(Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("heading", F.coalesce(before, F.lit(""))).where("tag = 'a'")
    return d.select(key, "pre", "ancestors", _attr("href").alias("href"), F.col("text").alias("label"), _attr("title").alias("title"), _attr("aria-label").alias("aria"), "alt", "has_image", _attr("target").alias("target"), _attr("rel").alias("rel"), "heading")


# Labels that name no organisation.
IDLE_LABELS = ["website", "webseite", "homepage", "link", "more", "read more", "mehr", "mehr erfahren", "here", "visit", "visit website", "learn more"]


def link_names(found: DataFrame, order: tuple[str, ...] = ("label", "title", "aria", "alt", "heading")) -> DataFrame:
    """links() with `name`: the first of the label, title, image text, heading and the host's
    name, in the order given, that has 2 to 200 characters and isn't an idle label."""
    fit = lambda c: F.when((F.char_length(F.trim(c)) >= 2) & (F.char_length(F.trim(c)) <= 200) & ~F.lower(F.trim(c)).isin(*IDLE_LABELS), F.trim(c))
    host = urls.domain(F.col("href"), "strip")
    label = F.get(F.split(host, r"\."), F.lit(0))
    return found.withColumn("name", F.coalesce(*(fit(F.col(c)) for c in order), F.nullif(F.concat(F.upper(F.substring(label, 1, 1)), F.substring(label, 2, 1 << 30)), F.lit("")), F.lit("")))


def card_links(e: DataFrame, key: str, card: Column, own: str = "", headings: tuple[str, ...] = HEADINGS, sections: tuple[str, ...] = ("h1", "h2")) -> DataFrame:
    """(key, card, section, name, href, score): of every element that is a card, the best link that
    isn't in a card inside it.

    card: a condition on tag and attrs. The name is the card's first heading, else that of its
    best link by link_names(), without headings outside the card; section is the nearest heading of some levels before the card
    or in it. Cards without a link that counts have no row.
    """
    cards = e.where(card)
    found = inside(links(e, key), cards, key).withColumnRenamed("within", "card")
    titles = inside(e.where(F.col("tag").isin(*headings)), cards, key).select(key, "pre", F.col("within").alias("card"))
    text = inner_text(e, e.where(F.col("tag").isin(*headings)), key).select(key, "pre", "text")
    first = titles.join(by_shuffle(text), [key, "pre"]).where("text <> ''").groupBy(key, "card").agg(F.min_by("text", "pre").alias("titled"))
    named = link_names(found, ("label", "title", "aria", "alt")).join(by_shuffle(first), [key, "card"], "left").withColumn("name", F.coalesce("titled", "name"))
    points = card_link_points(F.col("href"), F.col("label"), F.col("rel"), F.col("target"), F.col("name"), own or "\0")
    best = _best(named, key, points)
    heads = e.where(F.col("tag").isin(*sections)).select(key, "pre").join(by_shuffle(text), [key, "pre"])
    places = heads.select(key, "pre", "text", F.lit(False).alias("is_card")).unionByName(best.select(key, F.col("card").alias("pre"), F.lit(None).cast("string").alias("text"), F.lit(True).alias("is_card")))
    section = F.last("text", ignorenulls=True).over(Window.partitionBy(key).orderBy("pre").rowsBetween(Window.unboundedPreceding, 0))
    placed = places.withColumn("section", section).where("is_card").select(key, F.col("pre").alias("card"), F.coalesce("section", F.lit("")).alias("section"))
    return best.join(by_shuffle(placed), [key, "card"]).select(key, "card", "section", "name", "href", "score")


def button_cards(e: DataFrame, key: str, says: Column, card: Column, own: str, name_tags: tuple[str, ...] = ("h3", "h4", "h5", "h6", "strong")) -> DataFrame:
    """(key, button, card, name, website) of pages whose tiles have a button and the name behind it:
    one row for each anchor whose lower-cased label fulfils `says` (a condition on `label`).

    The tile is the nearest element around the button that fulfils card. The website is the
    first link to another host in it, else the first address in its text; '' without one. The
    name is the next heading after the button, wherever it stands. Buttons without a tile or a
    name have no row; of rows with the same name on a page the first with a website counts,
    else the first.
    """
    found = links(e, key)
    buttons = found.withColumn("label", F.lower(F.trim("label"))).where(says).select(key, "pre", "ancestors")
    tiles = inside(buttons, e.where(card), key).select(key, F.col("pre").alias("button"), F.col("within").alias("card"))
    cards = tiles.select(key, F.col("card").alias("pre")).distinct()

    host = urls.domain(F.col("href"), "strip")
    other = (host != "") & ~host.contains(own) & F.lower("href").startswith("http")
    linked = inside(found.where(other), cards, key, nearest=False)
    linked = linked.select(key, F.col("within").alias("card"), "pre", F.trim("href").alias("site")).join(by_shuffle(tiles), [key, "card"]).where("pre <> button")
    linked = linked.groupBy(key, "button").agg(F.min_by("site", "pre").alias("linked"))
    text = inner_text(e, cards, key).select(key, F.col("pre").alias("card"), urls.first_url(F.col("text")).alias("told"))
    text = text.withColumn("told", F.when(F.lower("told").contains(own), "").otherwise(F.col("told")))

    heads = e.where(F.col("tag").isin(*name_tags))
    titles = inner_text(e, heads, key).select(key, "pre", F.col("text").alias("name"), F.lit(False).alias("is_button"))
    places = titles.unionByName(buttons.select(key, "pre", F.lit(None).cast("string").alias("name"), F.lit(True).alias("is_button")))
    after = F.first("name", ignorenulls=True).over(Window.partitionBy(key).orderBy("pre").rowsBetween(1, Window.unboundedFollowing))
    named = places.withColumn("name", after).where("is_button AND name <> ''").select(key, F.col("pre").alias("button"), "name")
    d = tiles.join(by_shuffle(named), [key, "button"]).join(by_shuffle(linked), [key, "button"], "left").join(by_shuffle(text), [key, "card"], "left")
    d = d.withColumn("website", F.coalesce("linked", "told", F.lit("")))
    return keep(d, [key, "name"], [F.col("website") == "", "button"]).select(key, "button", "card", "name", "website")


def _best(named: DataFrame, key: str, points: Column) -> DataFrame:
    d = named.withColumn("score", points).where("score >= 0")
    best = d.groupBy(key, "card").agg(F.max_by(F.struct("href", "name"), F.struct("score", (-F.col("pre")).alias("o"))).alias("b"), F.max("score").alias("score"))
    return best.select(key, "card", "b.href", "b.name", "score")
