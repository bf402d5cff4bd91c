"""Workbooks, documents, page descriptions, XML ranges and element tables against plain code."""

import bz2
import gzip
import io
import random
import zipfile
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from orgweave.sources import elements, markup, office, records, registry, workbook


def blobs(spark, rows):
    return spark.createDataFrame([(p, bytearray(b) if b is not None else None) for p, b in rows], "path string, content binary")


def rezipped(data, change):
    """A zipped file with some parts replaced."""
    out, z = io.BytesIO(), zipfile.ZipFile(io.BytesIO(data))
    parts = {n: z.read(n) for n in z.namelist()} | change
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as w:
        for n, b in parts.items():
            w.writestr(n, b)
    return out.getvalue()


# workbooks


def test_workbook_reads_back(spark, sf, tmp_path):
    """A table written as a workbook, read as a whole and by ranges of rows."""
    c = duckdb.sql(f"SELECT c_custkey, c_name, c_address, c_acctbal FROM '{sf}/customer.parquet' ORDER BY c_custkey").fetchall() if "c_address" in [x[0] for x in duckdb.sql(f"DESCRIBE FROM '{sf}/customer.parquet'").fetchall()] else duckdb.sql(f"SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM '{sf}/customer.parquet' ORDER BY c_custkey").fetchall()
    names = ["key", "name", "third", "balance"]
    (tmp_path / "a.xlsx").write_bytes(workbook.to_bytes({"one": [names, *map(list, c)], "two": [["k"], ["x"], [None], ["z"]]}))
    (tmp_path / "b.xlsx").write_bytes(workbook.to_bytes({"empty": [], "head": [["only", "header"]]}))
    whole = workbook.read(spark, f"{tmp_path}/*.xlsx")
    want = sorted((str(k), n, a, repr(float(b))) for k, n, a, b in c)
    got = workbook.named(whole.where("sheet_name = 'one'"), names)
    assert sorted((r.key, r["name"], r.third, repr(float(r.balance))) for r in got.collect()) == want
    assert [(r.row, r.fields) for r in whole.where("sheet_name = 'two'").orderBy("row").collect()] == [(2, {"k": "x"}), (4, {"k": "z"})]
    assert whole.where("sheet_name IN ('empty', 'head')").count() == 0
    spark.dataSource.register(workbook.WorkbookSource)
    for path in (str(tmp_path), f"{tmp_path}/*.xlsx", f"file://{tmp_path}/*.xlsx"):
        ranged = spark.read.format("workbook").option("rowsPerTask", 7).load(path)
        assert ranged.rdd.getNumPartitions() > len(c) / 7
        cut = lambda d: sorted((r.sheet_name, r.row, sorted(r.fields.items())) for r in d.collect())
        assert cut(ranged) == cut(whole)


def test_workbook_cells(spark):
    """Shared and rich strings, dates, errors, cells without a reference, and what isn't a workbook."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = f'<worksheet {main}><sheetData><row><c t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row><row r="5"><c r="A5" s="1"><v>45292.5</v></c><c s="2"><v>0.25</v></c><c r="C5" t="e"><v>#N/A</v></c><c r="AA5" t="str"><v>=x</v></c></row><row><c t="b"><v>0</v></c></row></sheetData></worksheet>'
    strings = f'<sst {main}><si><t>day</t></si><si><r><t>ri</t></r><r><t xml:space="preserve">ch </t></r><rPh><t>no</t></rPh></si></sst>'
    styles = f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="164"/></cellXfs></styleSheet>'
    data = rezipped(workbook.to_bytes({"s": []}), {"xl/worksheets/sheet1.xml": sheet, "xl/sharedStrings.xml": strings, "xl/styles.xml": styles})
    rows = workbook.rows(blobs(spark, [("a", data), ("b", b"PK"), ("c", None), ("d", rezipped(data, {"xl/worksheets/sheet1.xml": sheet[:-20]}))]))
    got = rows.where("source_file = 'a'").orderBy("row").collect()
    assert [(r.row, r.fields) for r in got] == [(5, {"day": "2024-01-01 12:00:00", "Unnamed: 1": "0.25", "Unnamed: 26": "=x"}), (6, {"day": "False"})]
    assert sorted(r.source_file for r in rows.where("sheet = -1").collect()) == ["b", "c", "d"]
    assert workbook.column("AA10") == 26 and [workbook.letters(k) for k in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert workbook.rows(blobs(spark, [])).count() == 0


def test_large_sheet_is_streamed(tmp_path):
    """Rows come before the sheet has been read to its end."""
    book = workbook.Workbook(io.BytesIO(workbook.to_bytes({"s": [["n", "t"], *([k, "x" * 20] for k in range(60_000))]})))
    assert book.last_row(0) == 60_001
    rows = book.records(0)
    assert next(rows) == (2, {"n": "0", "t": "x" * 20})
    assert [r[0] for r in book.records(0, 30_000, 30_003)] == [30_000, 30_001, 30_002]
    import tracemalloc

    tracemalloc.start()
    assert sum(1 for _ in rows) == 59_999
    assert tracemalloc.get_traced_memory()[1] < 3_000_000
    tracemalloc.stop()


def test_workbooks_and_broken_files_as_sources(spark, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(workbook.to_bytes({"a": [["Web", "Name", "kind"], ["x.de", "X", "e-waste"], [None, "none", None]], "b": [["Web"], ["y.de"]]}))
    (tmp_path / "v.xlsx").write_bytes(b"no workbook")
    text = ("Web,Name\n" + "".join(f"https://s{i}.de,{'x' * 30}{i}\n" for i in range(5000))).encode()
    (tmp_path / "good.csv.gz").write_bytes(gzip.compress(text))
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(text)[:-3000])
    (tmp_path / "bad.csv.bz2").write_bytes(bz2.compress(text)[:900] + b"?" * 50)
    src = [registry.Source(str(tmp_path / "*.xlsx"), "Web", "Name", "Firms", "kind", add_protocol=True), registry.Source(str(tmp_path / "*.csv.*"), "Web", "Name", "c")]
    df, skipped = registry.scan(spark, src)
    assert [(r.url, r.name, r.category) for r in df.where("src = 0").orderBy("ord").collect()] == [("https://x.de", "X", "Firms - E-Waste"), ("", "none", "Firms")]
    assert 5000 <= df.where("src = 1").count() < 15_000
    told = sorted(s.split(":")[1].rpartition("/")[2] for s in skipped)
    assert told == ["bad.csv.bz2", "cut.csv.gz", "v.xlsx"]
    (tmp_path / "two.csv.gz").write_bytes(gzip.compress(b"a\n1\n") + gzip.compress(b"2\n"))
    assert {r.path.rpartition("/")[2] for r in registry.broken(spark, str(tmp_path / "*.gz")).collect()} == {"cut.csv.gz"}


# documents


def test_document_blocks(spark):
    data = office.document_bytes([(1, "Sec  A"), "para & <b>", [["Name", "Web"], ["Org", "https://o.de"]], (4, "low"), (2, "Sec B"), [["a"]]])
    rows = office.documents(blobs(spark, [("d", data), ("x", b"?"), ("n", None)]))
    got = [(r.block, r.part, r.section, r.row, r.cell, r.level, r.text) for r in rows.where("path = 'd'").orderBy("block", "row", "cell").collect()]
    a, b = "Sec A", "Sec B"
    assert got == [
        (0, None, a, None, None, 1, "Sec  A"), (1, None, a, None, None, None, "para & <b>"), (2, 0, a, 0, 0, None, "Name"), (2, 0, a, 0, 1, None, "Web"), (2, 0, a, 1, 0, None, "Org"), (2, 0, a, 1, 1, None, "https://o.de"),
        (3, None, a, None, None, 4, "low"), (4, None, b, None, None, 2, "Sec B"), (5, 1, b, 0, 0, None, "a"),
    ]
    assert {r.path for r in rows.where("error IS NOT NULL").collect()} == {"x", "n"}
    found = markup.table_entities(office.table_cells(rows)).collect()
    assert [(r.doc, r.part, r.section, r.organization, r.website_url) for r in found] == [("d", 0, a, "Org", "https://o.de")]


def test_merged_cells_and_breaks():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t, about="": f"<w:tc><w:tcPr>{about}</w:tcPr><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    body = "<w:tbl><w:tr>" + cell("a", '<w:gridSpan w:val="2"/>') + cell("b", '<w:vMerge w:val="restart"/>') + "</w:tr><w:tr>" + cell("c") + cell("d") + cell("", "<w:vMerge/>") + "</w:tr></w:tbl><w:p><w:r><w:t>x</w:t><w:tab/><w:br/><w:t>y</w:t></w:r></w:p>"
    data = rezipped(office.document_bytes([]), {"word/document.xml": f"<w:document {w}><w:body>{body}</w:body></w:document>"})
    got = list(office.document_blocks(data))
    assert [(r[3], r[4], r[6]) for r in got[:-1]] == [(0, 0, "a"), (0, 1, "a"), (0, 2, "b"), (1, 0, "c"), (1, 1, "d"), (1, 2, "b")]
    assert got[-1][6] == "x\t\ny"


def test_page_lines(spark):
    pages = [["• Grün (x) \\ – y", "zwei )(", "  "], [], ["drei"]]
    want = [(0, 0, "• Grün (x) \\ – y"), (0, 1, "zwei )("), (2, 0, "drei")]
    rows = office.page_lines(blobs(spark, [("a", office.page_bytes(pages)), ("b", office.page_bytes(pages, False)), ("x", b"%!"), ("y", b"%PDF-1.4 /Encrypt"), ("n", None)]))
    for p in "ab":
        assert [(r.page, r.line, r.text) for r in rows.where(f"path = '{p}'").orderBy("page", "line").collect()] == want
    assert {r.path for r in rows.where("error IS NOT NULL").collect()} == {"x", "y", "n"}


def test_page_text_operators():
    """Arrays with wide gaps, hexadecimal strings, fonts with a table of two-byte codes, positions."""
    cmap = b"1 beginbfrange\n<0001> <0003> <0041>\nendbfrange\n1 beginbfchar\n<0009> <00DF0073>\nendbfchar"
    body = rb"BT /F1 9 Tf [(A) -20 (B) -500 (C)] TJ 10 0 Td (\344\(D\)) Tj 0 -12 Td <4546> Tj /F2 9 Tf 1 0 0 1 5 5 Tm <00010003> Tj <0009> Tj T* (\000\002) ' ET"
    obj = [b"<</Type/Catalog/Pages 2 0 R>>", b"<</Type/Pages/Kids[3 0 R]/Resources 6 0 R>>", b"<</Type/Page/Contents[4 0 R]>>", b"<</Length 9 0 R>>\nstream\n" + body + b"\nendstream", b"<</Type/Font/Subtype/Type0/ToUnicode 7 0 R>>", b"<</Font<</F1 8 0 R/F2 5 0 R>>>>", b"<</Length %d>>stream\n" % len(cmap) + cmap + b"\nendstream", b"<</Type/Font/Subtype/Type1>>", b"%d" % len(body)]
    data = b"%PDF-1.5\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % (k, o) for k, o in enumerate(obj, 1))
    assert [t for _, _, t in office.Pages(data).lines()] == ["AB C ä(D)", "EF", "ACßs", "B"]


# XML


def test_xml_ranges_don_t_show(spark, tmp_path):
    """One file read in many tasks has the records that one task has, each once."""
    r = random.Random(4)
    body = "".join(f'<rec id="{i}" x="a>b">\n<n>{"y" * r.randrange(400)}</n><m><k>{i}</k><k/></m></rec>{r.choice(["", chr(10), "<!-- <rec> -->", "<other><n>1</n></other>", "<rec empty=%s/>" % repr(str(i))])}' for i in range(3000))
    (tmp_path / "a.xml").write_text(f'<?xml version="1.0"?>\n<root>{body}</root>\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    out = {}
    try:
        for size in ("1g", "20k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            d = records.read_xml_records(spark, str(tmp_path / "a.xml"), "rec")
            out[size] = d.rdd.getNumPartitions(), sorted(map(repr, d.select("xml", "fields").collect())), sorted(map(repr, records.tag_census(spark, str(tmp_path / "a.xml")).collect())), d.orderBy("ord").where("fields['@id'] IS NOT NULL").select(F.expr("fields['@id']")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert out["1g"][0] < 3 and out["20k"][0] > 20
    assert out["1g"][1:] == out["20k"][1:]
    assert [int(x[0]) for x in out["20k"][3]] == list(range(3000))
    d = records.read_xml_records(spark, str(tmp_path / "a.xml"), "rec")
    assert d.where("fields IS NULL").count() == 0
    one = next(x.fields for x in d.collect() if x.fields.get("@id") == "7")
    assert one["@x"] == "a>b" and one["m.k"] == "7" and "m.k__2" not in one
    assert records.record_tag(records.tag_census(spark, str(tmp_path / "a.xml"))) == "m"


def test_xml_odd_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("")
    (tmp_path / "b.xml").write_text("<root><rec><a>1</b></rec><rec>2</rec><records/><rec><a>3")
    got = [(r.xml, r.fields) for r in records.read_xml_records(spark, str(tmp_path), "rec").orderBy("ord").collect()]
    assert got[:2] == [("<rec><a>1</b></rec>", None), ("<rec>2</rec>", {})]
    assert all(f is None for _, f in got[2:])
    assert records.record_tag(records.tag_census(spark, str(tmp_path))) is None


# element tables


class Walk(HTMLParser):
    """A plain tree for pages whose elements are all closed: (tag, children) and texts."""

    def __init__(self):
        super().__init__()
        self.root = ("", [])
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = (tag, [], dict(attrs))
        self.stack[-1][1].append(node)
        if tag not in elements.VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def random_page(r, depth=0):
    if depth > 5 or r.random() < 0.25:
        return r.choice(["text", " b &amp; c ", "", "<img alt='i'>", "<!-- <a>no</a> -->", "<br>"])
    tag = r.choice(["div", "span", "b", "section", "h2"])
    return f"<{tag} class='{r.choice('xyz')}'>" + "".join(random_page(r, depth + 1) for _ in range(r.randrange(4))) + f"</{tag}>"


def test_elements_equal_a_tree_walk(spark):
    r = random.Random(6)
    pages = [(k, "".join(random_page(r) for _ in range(4))) for k in range(60)]
    e = elements.elements(spark.createDataFrame(pages, "k int, html string"), "k")
    rows = {}
    for x in e.collect():
        rows.setdefault(x.k, {})[x.pre] = x
    for k, html in pages:
        w, want = Walk(), []
        w.feed(html)
        w.close()

        def walk(node, up):
            for child in node[1]:
                if isinstance(child, str):
                    if child.strip():
                        want.append(("#text", up, " ".join(child.split())))
                    continue
                at = len(want)
                want.append((child[0], up, None))
                walk(child, [*up, at])

        walk(w.root, [])
        mine = rows.get(k, {})
        assert [(x.tag, x.ancestors, x.text) for _, x in sorted(mine.items())] == want
        for pre, x in mine.items():  # numbers of both orders tell what is inside
            assert [p for p, y in mine.items() if pre in y.ancestors] == list(range(pre + 1, x.last + 1))
            assert all((pre < p and y.post < x.post) == (pre in y.ancestors) for p, y in mine.items())
            assert x.parent == (x.ancestors[-1] if x.ancestors else None) and x.depth == len(x.ancestors)
    of = e.where("tag = 'div'")
    text = {(x.k, x.pre): (x.text, x.alt, x.has_image) for x in elements.inner_text(e, of, "k").collect()}
    for (k, pre), (t, alt, image) in text.items():
        below = [y for p, y in sorted(rows[k].items()) if pre in y.ancestors]
        assert t == " ".join(y.text for y in below if y.tag == "#text") and image == any(y.tag == "img" for y in below) and alt == ("i" if image else "")
    inner, outer = e.where("tag = 'span'"), e.where("attrs['class'] = 'x'")
    near = {(x.k, x.pre): x.within for x in elements.inside(inner, outer, "k").collect()}
    xs = {(x.k, x.pre) for x in outer.collect()}
    assert near == {(x.k, x.pre): max(a for a in x.ancestors if (x.k, a) in xs) for x in inner.collect() if any((x.k, a) in xs for a in x.ancestors)}


def test_unclosed_elements(spark):
    html = "<ul><li>1<ul><li>2<li>3</ul><li>4</ul><p>a<p>b<div>c</div><table><tr><td>5<td>6<tr><td>7</table></b></p><a href=x>l<a href=y>m"
    e = elements.elements(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "</div>")], "k int, html string"), "k")
    depth = {x.text: x.depth for x in e.where("tag = '#text'").collect()}
    assert depth == {"1": 2, "2": 4, "3": 4, "4": 2, "a": 1, "b": 1, "c": 1, "5": 3, "6": 3, "7": 3, "l": 1, "m": 1}
    assert {x.k for x in e.collect()} == {1}


def test_link_names(spark):
    html = "<h2>Head <i>one</i></h2><a href='https://www.abc-def.de'>Website</a><a href='https://b.de' title='T t'>link</a><h3>Two</h3><a href='https://c.de'><img title='Pic'></a><a href='https://d.de'> Own <b>name</b></a>"
    found = elements.links(elements.elements(spark.createDataFrame([(1, html)], "k int, html string"), "k"), "k")
    got = {x.href: (x.label, x.alt, x.has_image, x.heading, x.name) for x in elements.link_names(found).collect()}
    assert got == {"https://www.abc-def.de": ("Website", "", False, "Head one", "Head one"), "https://b.de": ("link", "", False, "Head one", "T t"), "https://c.de": ("", "Pic", True, "Two", "Pic"), "https://d.de": ("Own name", "", False, "Two", "Own name")}
    assert {x.name for x in elements.link_names(found, ("label", "title")).collect()} == {"Abc-def", "T t", "C", "Own name"}
