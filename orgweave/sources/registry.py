"""Delimited sources by a registry: which columns of which file give url, name, category."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls


@dataclass(frozen=True)
class Source:
    """path may be a glob. multiline: values have line breaks, so a file is read as a whole by
    one task; without, a large file is split."""

    path: str
    url: str
    name: str
    category: str
    custom: str | None = None
    add_protocol: bool = False
    multiline: bool = True


def read_csv(spark: SparkSession, path: str, multiline: bool = True, skip_bad: bool = True) -> DataFrame:
    """All columns as strings; quoted line breaks and doubled quotes belong to a value. Empty
    files have no rows; skip_bad: files that can't be read have none either."""
    options = {"header": True, "multiLine": multiline, "escape": '"', "inferSchema": False, "ignoreCorruptFiles": skip_bad}
    return spark.read.options(**options).csv(path)


def in_order(df: DataFrame) -> Column:
    """The place of a row of a file scan: its file's path, where the split begins, and the row
    within the split."""
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("row"))


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def broken(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason) of compressed files that can't be read to their end; rows that read_csv has
    of such a file are only those before the fault. Files that aren't compressed can't break."""
    import bz2
    import zlib
    from collections.abc import Iterator

    import pyarrow as pa

    kinds = {".gz": (lambda: zlib.decompressobj(31), zlib.error), ".bz2": (bz2.BZ2Decompressor, OSError)}

    def fault(path: str, data) -> str | None:
        make, error = kinds[path[path.rindex(".") :].lower()]
        reader, at = make(), 0
        try:
            while at < len(data):
                reader.decompress(data[at : at + 65536])
                at += 65536
                if reader.eof:
                    at = at - len(reader.unused_data) if reader.unused_data else at
                    reader = make() if at < len(data) else reader
            return None if not len(data) or reader.eof else "ends too early"
        except error as e:
            return str(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, data in zip(b.column(0).to_pylist(), b.column(1)):
                why = fault(p, memoryview(data.as_buffer()))
                if why:
                    yield pa.RecordBatch.from_pydict({"path": [p], "reason": [why]})

    files = spark.read.format("binaryFile").load(path).where(F.lower("path").rlike(r"\.(gz|bz2)$"))
    return files.select("path", "content").mapInArrow(run, "path string, reason string")


#: Broken files of a source that scan() names.
NAMED = 100


def _sheet(spark: SparkSession, s: Source) -> tuple[DataFrame, Column, DataFrame]:
    """The wanted columns of the first sheets of a source's workbooks, their order, and what
    couldn't be read."""
    from ..scratch import written
    from . import workbook

    rows = written(workbook.read(spark, s.path, "first"))
    there = rows.where("sheet >= 0").select(F.explode(F.map_keys("fields")).alias("c")).where(F.col("c").isin([c for c in (s.url, s.name, s.custom) if c])).distinct()
    names = [r.c for r in there.collect()]  # three at most
    df = rows.where("sheet >= 0").select("source_file", "row", *(F.try_element_at("fields", F.lit(c)).alias(c) for c in names))
    order = F.struct(F.col("source_file").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("row").alias("row"))
    return df, order, rows.where("sheet < 0").select(F.col("source_file").alias("path"), F.try_element_at("fields", F.lit("error")).alias("reason"))


def scan(spark: SparkSession, sources: list[Source]) -> tuple[DataFrame | None, list[str]]:
    """(url, name, category, src, ord) of all sources, and why sources or files were skipped.

    A missing file or column skips its source; of a file that breaks off the rows before the
    fault count, and it is told. ord is the place in the source: files by path, then lines
    as they stand (see in_order). Of workbooks the first sheet counts.
    """
    frames, skipped = [], []
    for k, s in enumerate(sources):
        if not exists(spark, s.path):
            skipped.append(f"{s.path}: no such file")
            continue
        if s.path.lower().endswith((".xlsx", ".xlsm")):
            df, order, faults = _sheet(spark, s)
        else:
            df = read_csv(spark, s.path, s.multiline)
            order, faults = in_order(df), broken(spark, s.path)
        faults = [f"{r.path}: {r.reason}" for r in faults.orderBy("path").limit(NAMED + 1).collect()]
        skipped += faults if len(faults) <= NAMED else [*faults[:NAMED], f"{s.path}: more files like that"]
        if s.url not in df.columns:
            skipped.append(f"{s.path}: no column {s.url}")
            continue
        name = F.col(f"`{s.name}`") if s.name in df.columns else F.lit("")
        custom = F.col(f"`{s.custom}`") if s.custom and s.custom in df.columns else F.lit(None).cast("string")
        url = urls.normalize(F.col(f"`{s.url}`"), s.add_protocol)
        frames.append(df.select(url.alias("url"), F.trim(F.coalesce(name, F.lit(""))).alias("name"), text.source_category(F.lit(s.category), custom).alias("category"), F.lit(k).alias("src"), order.alias("ord")))
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out, skipped


def ingest_stats(rows: DataFrame, url: str, source: str, order: list[str]) -> DataFrame:
    """Per source: total, no_url, duplicate (the url came before, in any source) and valid.
    Rows without a url are only counted; the others are summed by url before any ordering."""
    has = F.coalesce(F.col(url), F.lit("")) != ""
    total = rows.groupBy(source).agg(F.count("*").alias("total"), F.count_if(~has).alias("no_url"))
    first = rows.where(has).groupBy(url).agg(F.min_by(F.struct(F.col(source).alias("s")), F.struct(*order)).alias("first"))
    valid = first.groupBy(F.col("first.s").alias("__s")).agg(F.count("*").alias("valid"))
    met = total.join(valid, F.col(source).eqNullSafe(F.col("__s")), "left").withColumn("valid", F.coalesce("valid", F.lit(0)))
    return met.select(source, "total", "no_url", (F.col("total") - F.col("no_url") - F.col("valid")).alias("duplicate"), "valid")


def first_available(spark: SparkSession, paths: list[str]) -> str | None:
    """The first path of a chain of fallbacks that exists."""
    return next((p for p in paths if exists(spark, p)), None)


# What cells of a header look like, and how columns of names are called.
HEADER_CELLS = ["denumirea", "idno", "cod fiscal", "adresa", "cuatm", "licentiate", "nelicentiate"]
NAME_COLUMNS = [
    "denumire", "denumirea", "nume", "name", "titlu", "entitate", "institutie", "denumire juridica", "denumire completa", "denumire_completa",
    "denumirea companiei", "denumirea entitatii", "denumirea organizației", "denumirea organizatiei",
]
NAME_PARTS = ["denumir", "nume", "titlu", "entitat", "institut", "organiza", "compani", "firma"]
_UNNAMED = ("unnamed", "_c")


def promote_header(df: DataFrame, order: str, cells: list[str] = HEADER_CELLS) -> DataFrame:
    """A header that stands in the first row, by order, becomes the header: where half of the
    columns or more have no name and at least two cells look like one. That row goes, others
    stay, equal ones too; order stays a column."""
    columns = [c for c in df.columns if c != order]
    blank = [c for c in columns if not c or c.lower().startswith(_UNNAMED)]
    if not columns or 2 * len(blank) < len(columns):
        return df
    row = df.orderBy(order).first()
    values = [str(row[c]) if row is not None and row[c] is not None else "" for c in columns]
    if sum(any(k in v.lower() for k in cells) for v in values) < 2:
        return df
    at = df.agg(F.min(order).alias("__first"))
    rest = df.join(F.broadcast(at), F.col(order) > F.col("__first")).drop("__first")  # one row
    return rest.select(*(F.col(f"`{c}`").alias(v.strip() or c) for c, v in zip(columns, values)), order)


def name_column(df: DataFrame, exact: list[str] = NAME_COLUMNS, parts: list[str] = NAME_PARTS) -> str | None:
    """The column of names: by exact title, by part of a title, else by its values' shape, with
    one aggregation: 2 * share with letters + several words + length over 8 - share of bare
    numbers, if above 0; columns without a name or half of numbers are out. Else the first
    column with a letter."""
    low = {c.lower(): c for c in df.columns}
    for k in exact:
        if k in low:
            return low[k]
    named = [c for c in df.columns if not c.lower().startswith(_UNNAMED)]
    for c in named:
        if "unnamed" not in c.lower() and any(k in c.lower() for k in parts):
            return c
    if not df.columns:
        return None
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`").cast("string")
        share = lambda p, v=v: F.avg(v.rlike(p).cast("int"))
        words = F.size(F.filter(F.split(v, r"\s+"), lambda t: t != ""))
        aggs += [share("[A-Za-zĂÂÎȘŢăâîșțşţ]").alias(f"l{i}"), share(r"^[0-9\-.\s/]+$").alias(f"d{i}"), F.avg(words).alias(f"t{i}"), F.avg(F.char_length(v)).alias(f"n{i}"), F.max(v.rlike("[A-Za-z]")).alias(f"a{i}")]
    r = df.agg(*aggs).first()
    best, at = 0.0, None
    for i, c in enumerate(df.columns):
        if c not in named or r[f"l{i}"] is None or r[f"d{i}"] >= 0.5:
            continue
        score = 2 * r[f"l{i}"] + (r[f"t{i}"] > 1) + (r[f"n{i}"] > 8) - r[f"d{i}"]
        if score > best:
            best, at = score, c
    return at or next((c for i, c in enumerate(df.columns) if r[f"a{i}"]), None)


def settings(text: str) -> dict:
    """A YAML configuration as a dictionary; of a key that stands twice the last one counts."""
    import yaml

    return yaml.safe_load(text) or {}
