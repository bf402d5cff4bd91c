"""Sinks: single files, appends, versions with the table before kept, raw pages by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a file that one task writes.
FILE_ROWS = 1_000_000


def csv_file(df: DataFrame, path: str, rows: int = FILE_ROWS) -> int:
    """One CSV with a header, replaced, for results of a report's size; the number of files. More
    than `rows` rows are written by several tasks as several files, in order by name."""
    files = max(1, -(-df.count() // rows))
    df.coalesce(files).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return files


def json_lines(df: DataFrame, path: str, append: bool = True) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def json_document(df: DataFrame, order: list[str], write) -> int:
    """The rows as one JSON array, in order, given piece by piece to write(str); the number of
    rows. Rows come through an iterator, a partition at a time, so no task or driver holds
    the document. Letters stay as they are."""
    n = 0
    write("[")
    for n, r in enumerate(df.orderBy(*order).select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator(), 1):
        write(("\n  " if n == 1 else ",\n  ") + r.j)
    write("\n]" if n else "]")
    return n


def json_parts(df: DataFrame, order: list[str], path: str) -> None:
    """The rows as one JSON array over text files that all tasks write: the files one after the
    other, by name, are the document, a row a line. For documents that are too large for
    json_document(). Of rows that are equal by order any may be first."""
    from ..operators.windows import numbered
    from ..scratch import forget, unused, written

    at = unused(df, "number")
    json = F.to_json(F.struct(*df.columns))
    rows = written(numbered(df, [], order, at).select(at, json.alias("json")))
    n = rows.count()
    if n:
        line = F.concat(F.when(F.col(at) == 0, "[").otherwise(","), "json", F.when(F.col(at) == n - 1, "]").otherwise(""))
        rows.orderBy(at).select(line.alias("value")).write.mode("overwrite").text(path)
    else:
        df.sparkSession.createDataFrame([("[]",)], "value string").write.mode("overwrite").text(path)
    forget(rows)


def append_rows(df: DataFrame, path: str) -> None:
    """Rows appended to a table; readers that want the last row of a key use last_of(). Of a
    batch's rows those that stand later in df are later."""
    df.withColumns({"written_at": F.current_timestamp(), "written_as": F.monotonically_increasing_id()}).write.mode("append").parquet(path)


def last_of(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last appended row of each key: how an appended cache is read."""
    d = spark.read.parquet(path)
    rest = [c for c in d.columns if c not in keys and c not in ("written_at", "written_as")]
    got = d.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("written_at", "written_as")).alias("r"))
    return got.select(*keys, "r.*")


def parquet_or_csv(df: DataFrame, path: str) -> str:
    """Parquet; where the types can't be written so, CSV. The format that was written."""
    from pyspark.errors import AnalysisException

    try:
        df.write.mode("overwrite").parquet(path)
        return "parquet"
    except AnalysisException:
        csv_file(df.select(*(F.col(c).cast("string") for c in df.columns)), path)
        return "csv"


def versions(spark: SparkSession, path: str) -> list[int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(int(f.getPath().getParent().getName()[2:]) for f in found)


def write_version(df: DataFrame, path: str, kept: int = 2) -> int:
    """A new version beside the others; readers take the last complete one, and a backup of
    the table before is just the version before. The last `kept` versions stay."""
    from ..scratch import remove

    spark = df.sparkSession
    n = max(versions(spark, path), default=-1) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={n}")
    for old in versions(spark, path)[:-kept]:
        remove(spark, f"{path}/v={old}")
    return n


def read_version(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/v={max(versions(spark, path)) if n is None else n}")


def truncate(spark: SparkSession, path: str) -> int:
    return write_version(read_version(spark, path).limit(0), path)


def raw_pages(df: DataFrame, path: str, url: str = "url", digits: int = 2) -> None:
    """Pages by the first digits of their URL's hash, so that one is found without a scan."""
    key = F.sha2(url, 256)
    df.withColumn("url_hash", F.substring(key, 1, 16)).withColumn("part", F.substring(key, 1, digits)).write.mode("append").partitionBy("part").parquet(path)


def report(title: str, df: DataFrame, limit: int = 100) -> str:
    """A text report of an aggregate's first rows."""
    rows = df.limit(limit).collect()
    return "\n".join([title, "=" * len(title), *("  ".join(f"{k}: {v}" for k, v in r.asDict().items()) for r in rows), ""])
