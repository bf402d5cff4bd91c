"""Golden values and Python's own functions as oracles for the column expressions."""

import difflib
import unicodedata
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orgweave.functions import geo, scores, text, urls
from orgweave.regions import REGIONS


@pytest.fixture(scope="module")
def one(spark):
    def run(make, *rows, kind="string"):
        df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
        return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


def test_names(one):
    got = one(text.legal_name, "Foo GmbH", "Recycling AG & Co. KG", "Verlag", "Foo Agentur", "Green Ltd.", "Eco Center d.o.o.", None)
    assert got == ["foo", "recycling &", "verl", "fooentur", "green.", "eco center", ""]


def test_phones(one):
    assert one(text.phone, "+49 40 123456", "040/123456", "0049 40 123456", "+381 21 555", "40 12", None) == ["40123456", "040123456", "004940123456", "21555", "12", ""]


def test_normalize(one):
    got = one(lambda u: urls.normalize(u, add_protocol=True), "  https://a.b/x/?q=1 ", "https://a.b/", "a.b", "-", "https://h/p;v=1", "HTTP://A.b", None)
    assert got == ["https://a.b/x", "https://a.b/", "https://a.b", "", "https://h/p", "http://A.b", ""]
    assert one(urls.normalize, "ftp://a", "a.b") == ["", ""]
    assert one(urls.clean, "https://a.b/", "x//") == ["https://a.b", "x/"]


def test_match_key(one):
    rows = ["https://Ab.c:80/X/", "http://a.b", "no/scheme/", "https://müller.de/a_b//"]

    def key(u):
        p = urlparse(u)
        return f"{p.scheme}://{p.netloc.lower()}{p.path.rstrip('/')}"

    assert one(urls.match_key, *rows) == [key(u) for u in rows]


def test_titles(one):
    rows = ["e-waste R&D", "grün über 3d", "o'neil", ""]
    assert one(text.title, *rows) == [r.title() for r in rows]
    assert one(lambda c: text.category(c, "Other"), "e-waste R&D", "  ", None) == ["E-waste R&d", "Other", "Other"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aábçdeéöüßñžșћйĳ Ab", max_size=12), min_size=1, max_size=8))
def test_marks(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string")
    got = [r.y for r in df.select("i", text.strip_marks(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == ["".join(c for c in unicodedata.normalize("NFD", r) if unicodedata.category(c) != "Mn") for r in rows]


def test_repair(one):
    rows = ["MÃ¼ller", "Müller", "日本", "plain", None]
    assert one(text.repair_encoding, *rows) == ["Müller", "Müller", "日本", "plain", None]


def test_ratio(spark):
    pairs = [("hamburg waser", "hamburg wasser"), ("tide", "diet"), ("diet", "tide"), ("", ""), (None, "a"), ("tuhh", "technical university of hamburg")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r.y for r in df.select("i", text.sequence_ratio(F.col("a"), F.col("b")).alias("y")).orderBy("i").collect()]
    want = [None if a is None else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert [round(g, 9) if g is not None else None for g in got] == [round(w, 9) if w is not None else None for w in want]


def test_jaccard(spark):
    rows = [("Recycling Infrastructure & Services", "Recycling Infrastructure", 0.5), ("Repair Services", "repair services", 1.0), ("", "x", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, j double")
    for r in df.withColumn("y", text.jaccard(text.blank_words(F.col("a")), text.blank_words(F.col("b")))).collect():
        assert r.y == r.j


def test_distances(spark):
    r = spark.range(1).select(geo.haversine(*map(F.lit, (53.5511, 9.9937, 53.550341, 10.000654))).alias("a"), geo.haversine_atan(*map(F.lit, (53.5511, 9.9937, 52.52, 13.405))).alias("b")).first()
    assert abs(r.a - 0.467084) < 1e-6 and abs(r.b - 255.250166) < 1e-6


def test_relevance(spark):
    df = spark.createDataFrame([("Eco Hotel", "", "lodging", "w", 4.6), (None, None, None, None, None)], "n string, q string, t string, w string, r double")
    got = [r.s for r in df.select(scores.relevance(F.col("n"), F.col("q"), scores.types(F.col("t")), F.col("w"), F.col("r")).alias("s")).collect()]
    assert got == [25.0, 50.0]
    kept = [r.k for r in spark.createDataFrame([("university, cafe",), ("cafe",), (None,)], "t string").select(scores.relevant_type(scores.types(F.col("t"))).alias("k")).collect()]
    assert kept == [True, False, True]


def test_tiers(spark):
    rows = [("directory", 30, "directory"), ("directory", 29, "not-found"), ("site", 70, "accepted"), ("site", 69, "review-needed"), ("site", 39, "not-found")]
    df = spark.createDataFrame(rows, "k string, s int, w string")
    assert all(r.t == r.w for r in df.withColumn("t", scores.tier(F.col("k"), F.col("s"))).collect())


def test_locality(one):
    assert one(lambda t: scores.locality(t, REGIONS["hamburg"]), "20539 Hamburg, 040 1", "Hamburg", None) == [1.0, 1 / 3, 0.0]
    assert one(lambda t: scores.locality(t, REGIONS["cahul"]), "MD-3901 Cahul +373 1", "md-3901") == [1.0, 0.0]


def test_roles(one):
    got = one(scores.role, "ngo network", "public policy unit", "xyz", " end-users ", None)
    assert got == ["Non-Governmental Organizations", "Public Authorities", "Industry Partners", "End-Users", "Industry Partners"]


def test_share(one):
    assert one(text.share, 85.0, 0.7, 1.0, None, kind="double") == [0.85, 0.7, 1.0, None]


def test_trackers(one):
    assert one(urls.without_trackers, "https://a/?utm_source=x&b=1", "https://a/?fbclid=1#t", "https://a/?b=1&gclid=3&c=2") == ["https://a/&b=1", "https://a/", "https://a/?b=1&c=2"]
    assert one(urls.document_url, " a.de/x). ", "https://a.de 3  2", "http://b.de/?", None, " ") == ["https://a.de/x", "https://a.de", "http://b.de/", "", ""]
    assert one(urls.first_url, "see (https://a.de/x) or b.de", "at B-c.org/y, z", "none", None) == ["https://a.de/x", "https://B-c.org/y", "", ""]


def test_display_names(one):
    rows = ["https://3d-print.de/x", "https://www.o2-shop.org", "https://a.b.c"]
    assert one(urls.display_name, *rows) == ["3D Print", "O2 Shop", "A"]
    known = {"uni-x.de": "University X"}
    assert one(lambda u: urls.organisation(u, known), "https://www.uni-x.de", "https://my.uni-x.de", "https://myuni-x.de", "https://www.my-Org.de/a", "https://solo") == ["University X", "University X", "University X", "My-org", "Solo"]


def test_items(spark):
    """The score of an item, branch by branch, and of several."""
    rows = [("metal scrap sorting", "metal", "sorting of scrap", 0.75), ("Metal", "METAL", None, 1.0), ("met", "Metal works", "", 0.85), ("scrap", "x", "All Scrap", 0.85), ("a b c", "a", "d", 0.0), ("a", None, None, 0.0)]
    d = spark.createDataFrame(rows, "q string, n string, d string, w double")
    assert [r.s for r in d.select(scores.item_match(F.col("q"), F.col("n"), F.col("d")).alias("s")).collect()] == [r[3] for r in rows]
    items = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("description")) for n, t in (("metal", "sorting of scrap"), ("x", "y"), ("Scrap", "metal scrap sorting"))))
    r = spark.range(1).select(scores.items_match(F.lit("metal scrap sorting"), items).alias("m")).first().m
    assert r.score == 0.85 and r.matched == ["metal", "Scrap"]
    none = spark.range(1).select(scores.items_match(F.lit("a"), F.lit(None).cast("array<struct<name string, description string>>")).alias("m")).first().m
    assert none.score == 0.0 and none.matched == []


def test_second_region(one):
    assert one(lambda t: scores.locality(t, REGIONS["novi_sad"]), "Нови Сад 21000", "НОВИ САД", "Futog 021") == [2 / 3, 1 / 3, 2 / 3]


def test_small_texts(one):
    assert one(lambda a: text.place_query(a, ", Hamburg, Germany"), "Kai 1", "Kai 1, HAMBURG, germany") == ["Kai 1, Hamburg, Germany", "Kai 1, HAMBURG, germany"]
    assert one(text.entry_name, "1 „Eco” pagina web: x.md", "Plain Name", 'the "Green" one') == ["Eco", "Plain Name", "Green"]
    assert one(text.without_legal_form, "Alpha GmbH", "beta e.V.", "Agentur") == ["Alpha", "beta", "Agentur"]
    assert one(lambda p: scores.recommendation(p, F.lit("Do it"))[0], "high", "Medium", "low") == [0.8, 0.7, 0.6]
    assert one(lambda p: scores.recommendation(p, F.lit("Do it"))[1], "high") == ["[HIGH] Do it"]
