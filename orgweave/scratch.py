"""Intermediate data in the folder that all executors share, and names that nobody uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate data: spark.checkpoint.dir.

    Where it is unset a temporary folder serves a local master; on a cluster that is an
    error, since executors don't see each other's folders.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not (sc.master == "local" or sc.master.startswith("local[")):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp())
    return sc._jsc.sc().getCheckpointDir().get()


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def place(spark: SparkSession, name: str) -> str:
    """A path of one's own in the shared folder; it goes when the session's JVM ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _hadoop(spark, path)
    fs.deleteOnExit(p)
    return path


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage and survives lost executors.

    Smaller than a checkpoint of the same rows; forget() removes it before the session ends.
    """
    spark = df.sparkSession
    path = place(spark, "table")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete what written() wrote, once nothing is left to read it."""
    for df in tables:
        remove(df.sparkSession, df.written_at)


def unused(df: DataFrame, name: str) -> str:
    """name, or name with underscores behind it until no column of df has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
