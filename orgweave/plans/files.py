"""Queries over readers of files: workbooks, large XML files, and pages as tables of elements."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..scratch import place, written
from ..sources import elements, records, registry, sinks, workbook
from .base import query, read


def _workbooks(spark, sf_dir):
    """A workbook for every 2,000 customers, a sheet for each of their nations with a header, and
    a first sheet whose header stands in its second row."""
    c = read(spark, sf_dir, "customer").select(F.expr("c_custkey div 2000").alias("book"), "c_nationkey", "c_custkey", "c_name", "c_mktsegment", "c_acctbal")

    def write(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("c_custkey")
        sheets = {"Lista": [[None, None, "t"], ["Denumirea", "IDNO", "Adresa"], *([n, k, None] for n, k in zip(g.c_name, g.c_custkey.tolist()))]}
        for nation, rows in g.groupby("c_nationkey"):
            sheets[f"Nation <{nation}> & co"] = [["name", "key", None, "name"], *([r.c_name, int(r.c_custkey), float(r.c_acctbal), r.c_mktsegment if r.c_custkey % 3 else None] for r in rows.itertuples())]
        return pd.DataFrame({"path": [f"book{g.book.iloc[0]}.xlsx"], "content": [workbook.to_bytes(sheets)]})

    return c.groupBy("book").applyInPandas(write, "path string, content binary")


@query("""SELECT 'book' || c_custkey // 2000 || '.xlsx' AS source_file, 'Nation <' || c_nationkey || '> & co' AS sheet_name, c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS second, round(c_acctbal, 2) AS unnamed FROM customer
UNION ALL SELECT 'book' || c_custkey // 2000 || '.xlsx', 'Lista', c_custkey, c_name, NULL, NULL FROM customer""")
def workbook_rows(spark, sf_dir):
    """All sheets of many workbooks, as strings: nameless and repeated columns, a header that a
    second row replaces."""
    rows = workbook.rows(_workbooks(spark, sf_dir))
    d = workbook.named(rows, ["name", "key", "Unnamed: 2", "name.1", "Denumirea", "IDNO"])
    return d.select("source_file", "sheet_name", F.coalesce("key", "IDNO").cast("bigint").alias("key"), F.coalesce("name", "Denumirea").alias("name"), F.col("`name.1`").alias("second"), F.round(F.col("`Unnamed: 2`").cast("double"), 2).alias("unnamed"))


def _xml(spark, sf_dir) -> str:
    """Parts as XML files: records over several lines, attributes, repeated and empty elements."""
    path = place(spark, "xml")
    text = lambda c: f"replace(replace({c}, '&', '&amp;'), '<', '&lt;')"
    p = read(spark, sf_dir, "part").selectExpr(f"""concat('<?xml version="1.0"?><!-- <part/> --><parts>\n<part id="', p_partkey, '">\n <name>', {text('p_name')}, '</name>', CASE WHEN p_partkey % 2 = 0 THEN concat('<size unit="&quot;cm>">', p_size, '</size>') ELSE '<size/>' END, '\n <tags><tag>', {text('p_type')}, '</tag><tag><![CDATA[', p_brand, ' & <co>]]></tag></tags></part></parts><part alone="', p_partkey, '" />') AS value""")
    p.write.text(path)
    return path


@query("""SELECT p_partkey AS id, trim(p_name) AS name, CASE WHEN p_partkey % 2 = 0 THEN '"cm>' END AS unit, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS size, p_type AS tag, p_brand || ' & <co>' AS tag2, false AS alone FROM part
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL, true FROM part""", ints=("size",))
def xml_ranges(spark, sf_dir):
    """Records of XML files that Spark splits by bytes, each read once."""
    r = records.read_xml_records(spark, _xml(spark, sf_dir), "part")
    f = lambda k: F.try_element_at("fields", F.lit(k))
    return r.select(F.coalesce(f("@id"), f("@alone")).cast("bigint").alias("id"), f("name").alias("name"), f("size@unit").alias("unit"), f("size").cast("bigint").alias("size"), f("tags.tag").alias("tag"), f("tags.tag__2").alias("tag2"), f("@alone").isNotNull().alias("alone"))


@query("""WITH n AS (SELECT count(*) AS n FROM part) SELECT unnest(['parts', 'part', 'name', 'size', 'tags', 'tag']) AS tag, unnest([n, 2 * n, n, n, n, 2 * n]) AS n, unnest([n, n, 0, 0, n, 0]) AS parents FROM n""", ints=("n", "parents"))
def xml_tag_census(spark, sf_dir):
    return records.tag_census(spark, _xml(spark, sf_dir))


@query("""SELECT page_id, tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY 1, 2""")
def page_elements(spark, sf_dir):
    """Elements of every page by tag; unclosed ones count like others."""
    return elements.elements(read(spark, sf_dir, "pages"), "page_id").where("attrs IS NOT NULL").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT c_custkey // 20 AS page, c_custkey AS k, c_name AS n, c_mktsegment AS s, c_custkey % 20 // 5 AS sec FROM customer)
SELECT page, 'Section ' || sec AS section, CASE WHEN k % 4 = 0 THEN 'Logo ' || n WHEN k % 4 = 1 THEN 'C' || k ELSE n || ' & co' END AS name, 'https://c' || k || '.example.com/' || CASE WHEN k % 4 = 1 THEN '' ELSE 'x' END AS href, true AS inner FROM c
UNION ALL SELECT page, 'Section ' || sec, 'Outer ' || s, 'https://outer' || k || '.example.org', false FROM c""")
def nested_cards(spark, sf_dir):
    """Directory pages with cards inside cards, comments, unclosed elements, images as links: the
    best link of each card, its name and the heading of its section."""
    c = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey div 20 AS page", "c_custkey AS k",
        """concat(CASE WHEN c_custkey % 5 = 0 OR c_custkey = 1 THEN concat('<h2>Section <b>', c_custkey % 20 div 5, '</b></h2>') ELSE '' END, '<div class="x Card"><p>Member<a href="/own">x</a><!-- <a href="https://no.example">Website</a> -->',
        '<ul><li class=card>', CASE WHEN c_custkey % 4 >= 2 THEN concat('<h3>', c_name, ' &amp; co</h3>') ELSE '' END, '<p>some text<p>more <a href="https://c', c_custkey, '.example.com/', CASE WHEN c_custkey % 4 = 1 THEN '' ELSE 'x' END, '">',
        CASE c_custkey % 4 WHEN 0 THEN concat('<img src=l alt="Logo ', c_name, '">') WHEN 1 THEN 'Website' ELSE 'go' END, '</a><li>no card</ul><script>var a = "<a href=https://s.example>";</script><a href="https://outer', c_custkey, '.example.org"> Outer <i>', c_mktsegment, '</i></a></div>') AS html""",
    )
    pages = c.groupBy("page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "html"))), lambda x: x["html"]), "\n").alias("html"))
    e = elements.elements(written(pages), "page")
    found = elements.card_links(e, "page", elements.has_class("card"), "own.example")
    return found.select("page", "section", "name", "href", F.col("href").contains("//c").alias("inner"))


@query("""SELECT c_custkey // 20 AS page, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'https://m' || c_custkey || '.example.com/a' WHEN c_custkey % 3 = 1 THEN 'https://t' || c_custkey || '.example.org' ELSE '' END AS website FROM customer""")
def button_cards(spark, sf_dir):
    """Member tiles with a button before their name; the website is a link in the tile, an address
    in its text, or missing. A name that comes twice keeps the tile with a website."""
    tile = """concat('<div class="tile big"><p>Member<a href="https://chamber.example.md/', c_custkey, '">profile</a>',
        CASE c_custkey % 3 WHEN 0 THEN concat('<a href="/in">x</a><a href="https://m', c_custkey, '.example.com/a"><img alt=a></a><a href="https://second.example.com">y</a>') WHEN 1 THEN concat('<!-- https://no.example --><p>see https://t', c_custkey, '.example.org now') ELSE '' END,
        '<a class=b href="/member"><span> Read </span>More</a></div><h4>', c_name, '</h4>', CASE WHEN c_custkey % 3 = 0 THEN concat('<div class=tile><a>read more</a></div><strong>', c_name, '</strong>') ELSE '' END)"""
    c = read(spark, sf_dir, "customer").selectExpr("c_custkey div 20 AS page", "c_custkey AS k", f"{tile} AS html")
    pages = c.groupBy("page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "html"))), lambda x: x["html"]), "").alias("html"))
    e = elements.elements(pages, "page")
    return elements.button_cards(e, "page", F.col("label") == "read more", elements.has_class("tile"), "chamber.example.md").select("page", "name", "website")


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, row_number() OVER (ORDER BY c_acctbal, c_custkey) = 1 AS is_first, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey DESC) = 1 AS is_last FROM customer""")
def json_document_parts(spark, sf_dir):
    """Customers as one JSON array over many files, read back line by line."""
    path = place(spark, "json")
    sinks.json_parts(read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"), ["balance", "id"], path)
    line = F.col("value")
    row = F.from_json(F.regexp_replace(line, r"^[\[,]|\]$", ""), "id bigint, name string, balance double")
    return spark.read.text(path).select(row.alias("r"), line.startswith("[").alias("is_first"), line.endswith("]").alias("is_last")).select("r.*", "is_first", "is_last")


@query("SELECT s_suppkey AS k, s_name AS before, CASE WHEN s_suppkey % 3 <> 0 THEN upper(s_name) END AS now, 2 AS n_versions FROM supplier", ints=("n_versions",))
def table_versions(spark, sf_dir):
    """A table written three times: the version before the last one, the last one, and how many stay."""
    path = place(spark, "versions")
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS k", "s_name AS name")
    for v in (s.limit(0), s, s.where("k % 3 <> 0").withColumn("name", F.upper("name"))):
        sinks.write_version(v, path)
    kept = sinks.versions(spark, path)
    now = sinks.read_version(spark, path).withColumnRenamed("name", "now")
    return sinks.read_version(spark, path, kept[0]).withColumnRenamed("name", "before").join(now, "k", "left").withColumn("n_versions", F.lit(len(kept)).cast("bigint"))


@query("SELECT page_id, substr(sha256(url), 1, 16) AS url_hash, length(html) AS n FROM pages", ints=("n",))
def raw_page_store(spark, sf_dir):
    """Pages stored under the first digits of their address's hash, each found in its part."""
    path = place(spark, "raw")
    p = read(spark, sf_dir, "pages")
    sinks.raw_pages(p, path)
    kept = spark.read.option("basePath", path).schema(f"{', '.join(f'{n} {t}' for n, t in p.dtypes)}, url_hash string, part string").parquet(path)
    return kept.where(F.col("part") == F.substring("url_hash", 1, 2)).select("page_id", "url_hash", F.char_length("html").cast("bigint").alias("n"))


@query("SELECT event_id AS id, event_type AS kind, value, event_id % 2 AS batch FROM events", ints=("batch",))
def json_lines_appended(spark, sf_dir):
    path = place(spark, "lines")
    e = read(spark, sf_dir, "events").selectExpr("event_id AS id", "event_type AS kind", "value", "event_id % 2 AS batch")
    for k in (0, 1):
        sinks.json_lines(e.where(f"batch = {k}"), path)
    return spark.read.schema("id bigint, kind string, value double, batch bigint").json(path)


@query("SELECT s_name AS name, s_suppkey::VARCHAR AS idno, 'Denumirea organizației' AS name_column FROM supplier")
def header_repair(spark, sf_dir):
    """A table whose header stands in its first row, and which of its columns has names."""
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS ord", "s_name AS `Unnamed: 0`", "CAST(s_suppkey AS string) AS `Unnamed: 1`", "'x' AS `_c2`")
    head = spark.createDataFrame([(-1, "Denumirea organizației", "IDNO", "Adresa juridică")], s.schema)
    d = registry.promote_header(head.unionByName(s), "ord")
    name = registry.name_column(d.drop("ord"))
    return d.select(F.col(f"`{name}`").alias("name"), F.col("IDNO").alias("idno"), F.lit(name).alias("name_column"))
