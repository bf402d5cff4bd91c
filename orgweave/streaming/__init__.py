"""Structured Streaming forms of the resumable and rate-limited steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_only(stream: DataFrame, key: str, at: str, late: str = "1 day") -> DataFrame:
    """Rows of a stream, the first of each key within the watermark: an incremental run that
    skips what is done. State is bounded by the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def rates(stream: DataFrame, key: str, at: str, width: str = "1 second", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rows of each key in tumbling (or sliding) windows, for a rate limit."""
    w = F.window(at, width, slide) if slide else F.window(at, width)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def sessions(stream: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key: start, end, rows."""
    w = F.session_window(at, gap)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def upsert_batches(stream: DataFrame, target: str, keys: list[str], order: str, checkpoint: str, buckets: int = 64):
    """Start a query that merges every micro-batch into a Parquet table of key buckets.

    Rows lie in folders by the hash of their key. A batch reads and writes only the buckets
    that it has rows for; each is a version of its own, numbered by the batch, so a batch
    that is run again after a failure writes the same. read_upserted() takes the last
    version of every bucket; versions before the last two go.
    """
    from ..operators.merge import upsert
    from ..scratch import forget, remove, written

    at = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = written(batch.withColumn("bucket", at))
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most buckets
        last = {b: [v for v in of if v < n] for b, of in _versions(spark, target).items() if b in touched}
        paths = [f"{target}/bucket={b}/v={of[-1]}" for b, of in last.items() if of]
        old = spark.read.option("basePath", target).parquet(*paths).drop("v") if paths else rows.limit(0)
        new = upsert(old.withColumn("bucket", F.col("bucket").cast("int")), rows, keys, order)
        if touched:
            new.withColumn("v", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "v").parquet(target)
        for b, of in last.items():
            for v in of[:-1]:
                remove(spark, f"{target}/bucket={b}/v={v}")
        forget(rows)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark, target: str) -> dict[int, list[int]]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/bucket=*/v=*")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
    out: dict[int, list[int]] = {}
    for f in found:
        out.setdefault(int(f.getPath().getParent().getName()[7:]), []).append(int(f.getPath().getName()[2:]))
    return {b: sorted(v) for b, v in out.items()}


def read_upserted(spark, target: str) -> DataFrame:
    """The table that upsert_batches() keeps."""
    paths = [f"{target}/bucket={b}/v={of[-1]}" for b, of in _versions(spark, target).items()]
    return spark.read.option("basePath", target).parquet(*paths).drop("bucket", "v")
