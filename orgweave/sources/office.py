"""Documents: blocks of zipped XML word-processor files and text lines of page descriptions.

Files come as (path, content), as Spark's binaryFile gives them; a file is one task's work.
What can't be read gives a row that tells so.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = "path string, block int, part int, section string, row int, cell int, level int, text string, error string"
LINES = "path string, page int, line int, text string, error string"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: Headings up to this level name a section.
SECTION_LEVEL = 3
ROWS = 4096


def _text(p) -> str:
    kinds = {f"{_W}t": lambda e: e.text or "", f"{_W}tab": lambda e: "\t", f"{_W}br": lambda e: "\n", f"{_W}cr": lambda e: "\n"}
    return "".join(kinds[e.tag](e) for e in p.iter() if e.tag in kinds)


def _levels(z: zipfile.ZipFile) -> dict[str, int]:
    """Heading levels by the ids of paragraph styles."""
    if "word/styles.xml" not in z.namelist():
        return {}
    out = {}
    for s in ElementTree.parse(z.open("word/styles.xml")).getroot().iter(f"{_W}style"):
        name = s.find(f"{_W}name")
        m = re.fullmatch(r"heading (\d+)", (name.get(f"{_W}val") if name is not None else "").lower())
        if m:
            out[s.get(f"{_W}styleId")] = int(m[1])
    return out


def _matrix(table) -> list[list[str]]:
    """Cells of a table; one that spans columns or rows stands in each of them."""
    out: list[list[str]] = []
    for tr in table.iterfind(f"{_W}tr"):
        row: list[str] = []
        for tc in tr.iterfind(f"{_W}tc"):
            about = tc.find(f"{_W}tcPr")
            span = about.find(f"{_W}gridSpan") if about is not None else None
            merge = about.find(f"{_W}vMerge") if about is not None else None
            text = "\n".join(_text(p) for p in tc.iterfind(f"{_W}p"))
            if merge is not None and merge.get(f"{_W}val", "continue") == "continue" and out and len(row) < len(out[-1]):
                text = out[-1][len(row)]
            row += [text] * int(span.get(f"{_W}val") if span is not None else 1)
        out.append(row)
    return out


def document_blocks(content) -> Iterator[tuple]:
    """(block, part, section, row, cell, level, text) of a document's paragraphs and cells, in
    order. part numbers the tables; a paragraph has none, and no row and cell."""
    z = zipfile.ZipFile(io.BytesIO(content))
    levels = _levels(z)
    path, section, part, block = [], "", -1, -1
    for event, e in ElementTree.iterparse(z.open("word/document.xml"), ("start", "end")):
        if event == "start":
            path.append(e)
            continue
        path.pop()
        if len(path) < 2 or path[-1].tag != f"{_W}body":
            continue
        if e.tag == f"{_W}p":
            block += 1
            style = e.find(f"{_W}pPr/{_W}pStyle")
            level = levels.get(style.get(f"{_W}val")) if style is not None else None
            text = _text(e)
            name = re.sub(r"\s+", " ", text).strip()
            if level is not None and level <= SECTION_LEVEL and name:
                section = name
            yield block, None, section, None, None, level, text
        elif e.tag == f"{_W}tbl":
            block, part = block + 1, part + 1
            for i, row in enumerate(_matrix(e)):
                for j, text in enumerate(row):
                    yield block, part, section, i, j, None, text
        path[-1].clear()


# Characters of the standard encoding that aren't those of Latin-1, and escapes.
_WINDOWS = {k: bytes([k]).decode("cp1252", "replace") for k in range(0x80, 0xA0)}
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.|\([^()]*\))*\))*\)|<<|>>|<[0-9A-Fa-f\s]*>|[\[\]]|/[^\s/<>()\[\]{}%]*|[-+.0-9]+|[A-Za-z'\"*][A-Za-z0-9'\"*]*", re.S)


def _literal(t: bytes) -> bytes:
    if t[:1] == b"<":
        h = re.sub(rb"\s", b"", t[1:-1])
        return bytes.fromhex((h + b"0" * (len(h) % 2)).decode())

    def one(m):
        x = m[1]
        return bytes([int(x, 8) & 255]) if x[:1].isdigit() else _ESCAPES.get(x, b"" if x in (b"\n", b"\r", b"\r\n") else x)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, t[1:-1], flags=re.S)


class Pages:
    """Objects of a page description, and the text of its pages."""

    def __init__(self, data: bytes):
        if not data.lstrip()[:5] == b"%PDF-":
            raise ValueError("no page description")
        if b"/Encrypt" in data:
            raise ValueError("encrypted")
        self.objects: dict[int, tuple[bytes, bytes | None]] = {}
        at = 0
        while m := re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b").search(data, at):
            s, end = re.compile(rb"\bstream\r?\n").search(data, m.end()), data.find(b"endobj", m.end())
            end = len(data) if end < 0 else end
            if s and s.start() < end:
                head = data[m.end() : s.start()]
                n = re.search(rb"/Length\s+(\d+)(?!\s+\d+\s+R)", head)
                stop = s.end() + int(n[1]) if n and data[s.end() + int(n[1]) :].lstrip()[:9] == b"endstream" else data.find(b"endstream", s.end())
                self.objects[int(m[1])] = head, data[s.end() : stop]
                at = max(stop, data.find(b"endobj", stop))
            else:
                self.objects[int(m[1])] = data[m.end() : end], None
                at = end
        for k in [k for k, (head, _) in self.objects.items() if re.search(rb"/Type\s*/ObjStm", head)]:
            self._unpack(k)

    def _unpack(self, k: int) -> None:
        head, body = self.objects[k][0], self.stream(k)
        n, first = (int(re.search(rb"/%s\s+(\d+)" % w, head)[1]) for w in (b"N", b"First"))
        at = list(map(int, body[:first].split()[: 2 * n]))
        for i in range(n):
            end = first + at[2 * i + 3] if i + 1 < n else len(body)
            self.objects.setdefault(at[2 * i], (body[first + at[2 * i + 1] : end], None))

    def stream(self, k: int) -> bytes:
        head, body = self.objects.get(k, (b"", None))
        if body is None:
            return b""
        if b"/FlateDecode" in head:
            return zlib.decompressobj().decompress(body)
        return body if b"/Filter" not in head else b""

    def _value(self, head: bytes, key: bytes) -> bytes:
        """A dictionary's entry, followed through a reference."""
        m = re.search(rb"/%s\b\s*(?:(\d+)\s+\d+\s+R|(<<|\[)?)" % key, head)
        if not m:
            return b""
        if m[1]:
            return self.objects.get(int(m[1]), (b"", None))[0]
        depth, out = 0, head[m.end(0) - len(m[2] or b"") :]
        if not m[2]:
            return re.match(rb"\s*/?[^/>\]]*", out)[0].strip()
        for t in re.finditer(rb"<<|>>|\[|\]", out):
            depth += 1 if t[0] in (b"<<", b"[") else -1
            if depth == 0:
                return out[: t.end()]
        return out

    def pages(self) -> list[tuple[bytes, bytes]]:
        """(page, resources) in order."""
        root = next((re.search(rb"/Pages\s+(\d+)", h) for h, _ in self.objects.values() if re.search(rb"/Type\s*/Catalog", h)), None)
        out: list[tuple[bytes, bytes]] = []
        todo, seen = [(int(root[1]), b"")] if root else [(k, b"") for k, (h, _) in sorted(self.objects.items()) if re.search(rb"/Type\s*/Page\b", h)], set()
        while todo:
            k, resources = todo.pop(0)
            head = self.objects.get(k, (b"", None))[0]
            if k in seen:
                continue
            seen.add(k)
            resources = self._value(head, b"Resources") or resources
            if b"/Kids" in head:
                todo = [(int(x), resources) for x in re.findall(rb"(\d+)\s+\d+\s+R", self._value(head, b"Kids"))] + todo
            else:
                out.append((head, resources))
        return out

    def _font(self, k: int) -> tuple[int, dict[int, str]]:
        """(bytes of a code, text of codes) of a font."""
        head = self.objects.get(k, (b"", None))[0]
        m = re.search(rb"/ToUnicode\s+(\d+)", head)
        wide = 2 if re.search(rb"/Subtype\s*/Type0", head) else 1
        text: dict[int, str] = {}
        cmap = self.stream(int(m[1])) if m else b""
        whole = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        for part in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
            text |= {int(a, 16): whole(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]*)>", part)}
        for part in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
            for a, b, c, listed in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f]+)>|\[(.*?)\])", part, re.S):
                each = [whole(x) for x in re.findall(rb"<([0-9A-Fa-f]+)>", listed)]
                for n in range(int(a, 16), min(int(b, 16), int(a, 16) + 0xFFFF) + 1):
                    i = n - int(a, 16)
                    text[n] = each[i] if i < len(each) else whole(c[:-4])[:] + chr(int(c[-4:], 16) + i) if c else ""
        return wide, text

    def lines(self) -> Iterator[tuple[int, int, str]]:
        """(page, line, text): what is shown until the position moves to another line."""
        for number, (head, resources) in enumerate(self.pages()):
            fonts = {n: int(k) for n, k in re.findall(rb"/([^\s/<>\[\]]+)\s+(\d+)\s+\d+\s+R", self._value(resources, b"Font"))}
            held: dict[bytes, tuple] = {}
            contents = re.search(rb"/Contents\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", head)
            data = b"\n".join(self.stream(int(k)) for k in re.findall(rb"(\d+)\s+\d+\s+R", contents[1])) if contents else b""
            out, line, font, stack = "", 0, (1, {}), []

            def shown(s: bytes) -> str:
                wide, text = font  # noqa: B023
                codes = [int.from_bytes(s[i : i + wide], "big") for i in range(0, len(s), wide)]
                return "".join(text.get(c, _WINDOWS.get(c, chr(c)) if wide == 1 else "") for c in codes)

            for t in _TOKEN.findall(data):
                new = False
                if t == b"Tf" and len(stack) >= 2:
                    name = stack[-2][1:]
                    font = held.setdefault(name, self._font(fonts[name])) if name in fonts else (1, {})
                elif t in (b"Tj", b"'", b'"') and stack:
                    new = t != b"Tj"
                elif t in (b"Td", b"TD") and len(stack) >= 2:
                    new = float(stack[-1]) != 0
                    out += "" if new or not out else " "
                elif t == b"Tm" and len(stack) >= 6:
                    new = True
                elif t in (b"T*", b"ET"):
                    new = True
                if new and out.strip():
                    yield number, line, out.strip()
                    line += 1
                if new:
                    out = ""
                if t in (b"Tj", b"'", b'"') and stack and stack[-1][:1] in (b"(", b"<"):
                    out += shown(_literal(stack[-1]))
                elif t == b"TJ":
                    begin = len(stack) - 1 - stack[::-1].index(b"[") if b"[" in stack else len(stack)
                    for x in stack[begin:]:
                        if x[:1] in (b"(", b"<"):
                            out += shown(_literal(x))
                        elif re.fullmatch(rb"-?[0-9.]+", x) and float(x) < -200:
                            out += " "
                if t[:1].isalpha() or t in (b"'", b'"', b"T*"):
                    stack = []
                else:
                    stack.append(t)
            if out.strip():
                yield number, line, out.strip()


def _rows(files: DataFrame, parse, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.string()) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)

        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                held: list[tuple] = []
                try:
                    for r in parse(content.as_py() or b""):
                        held.append((path, *r, None))
                        if len(held) == ROWS:
                            yield batch(held)
                            held = []
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError, IndexError, zlib.error) as e:
                    held.append((path, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}"))
                if held:
                    yield batch(held)

    return files.select("path", "content").mapInArrow(run, schema)


def documents(files: DataFrame) -> DataFrame:
    """Paragraphs and table cells of word-processor files, in order: (path, block, part, section,
    row, cell, level, text, error). section is the last heading of level 3 or less; part
    numbers a file's tables and is null for paragraphs. Unreadable files have one row with
    error; empty ones none but that."""
    return _rows(files, document_blocks, BLOCKS)


def table_cells(blocks: DataFrame) -> DataFrame:
    """documents()' table cells as markup.table_entities takes them."""
    return blocks.where("part IS NOT NULL").select(F.col("path").alias("doc"), "part", "section", "row", "cell", "text")


def page_lines(files: DataFrame) -> DataFrame:
    """Text lines of page descriptions: (path, page, line, text, error). Streams that aren't
    compressed or are by deflate are read; codes become text by the font's table, else as
    Windows-1252. Unreadable and encrypted files have one row with error."""
    return _rows(files, lambda data: Pages(data).lines(), LINES)


def document_bytes(blocks: list) -> bytes:
    """A word-processor file of blocks: (level, text) for headings, a text for a paragraph, a list
    of rows for a table."""
    from xml.sax.saxutils import escape

    def paragraph(text: str, level: int | None = None) -> str:
        style = f'<w:pPr><w:pStyle w:val="H{level}"/></w:pPr>' if level else ""
        return f'<w:p>{style}<w:r><w:t xml:space="preserve">{escape(text)}</w:t></w:r></w:p>'

    def block(b) -> str:
        if isinstance(b, list):
            return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in r) + "</w:tr>" for r in b) + "</w:tbl>"
        return paragraph(b) if isinstance(b, str) else paragraph(b[1], b[0])

    out = io.BytesIO()
    space = f'xmlns:w="{_W[1:-1]}"'
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f"<w:document {space}><w:body>{''.join(map(block, blocks))}</w:body></w:document>")
        z.writestr("word/styles.xml", f"<w:styles {space}>" + "".join(f'<w:style w:styleId="H{k}"><w:name w:val="heading {k}"/></w:style>' for k in range(1, 10)) + "</w:styles>")
    return out.getvalue()


def page_bytes(pages: list[list[str]], compress: bool = True) -> bytes:
    """A page description with lines of text, in Windows-1252."""
    out, at = bytearray(b"%PDF-1.4\n"), []

    def add(body: bytes) -> None:
        at.append(len(out))
        out.extend(b"%d 0 obj\n%s\nendobj\n" % (len(at), body))

    n = len(pages)
    add(b"<< /Type /Catalog /Pages 2 0 R >>")
    add(b"<< /Type /Pages /Count %d /Kids [%s] >>" % (n, b" ".join(b"%d 0 R" % (4 + 2 * k) for k in range(n))))
    add(b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>")
    for k, lines in enumerate(pages):
        add(b"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 3 0 R >> >> /Contents %d 0 R >>" % (5 + 2 * k))
        text = b"".join(b"(%s) Tj T*\n" % re.sub(rb"([()\\])", rb"\\\1", x.encode("cp1252", "replace")) for x in lines)
        body = b"BT /F1 10 Tf 12 TL 50 800 Td\n" + text + b"ET"
        body = zlib.compress(body) if compress else body
        add(b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(body), b" /Filter /FlateDecode" if compress else b"", body))
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(at) + 1) + b"".join(b"%010d 00000 n \n" % x for x in at)
    out += b"trailer << /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(at) + 1, start)
    return bytes(out)
