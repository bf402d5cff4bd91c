"""Exact dedup against history: a minimal perfect hash over the distinct digests of all texts
that came before.

Digests are dealt to shards by their leading bits. A shard's hash function is a cascade of
bit arrays: a digest that is alone at its place of a level sets the bit there, the others go
on to the next level, and the set bits, counted through, number the shard's digests without
a gap. The slot of that number holds the whole digest, the locator of the row that stays,
and how many rows there were. A lookup follows the cascade to one slot and compares all
bytes; what is not equal, or meets no bit, is new and is grouped by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, hot_join, partitions, table, unused, written
from .tokens import mix

#: Digests of a shard, on average at most; a shard takes some 60 bytes for each.
SHARD = 1 << 14
#: Shards for each shuffle partition, at least, so that all tasks have some.
SPREAD = 8
#: Places of a level for each digest that is left.
ROOM = 1.5
WIDTH = 32


def digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes as 32 bytes; null counts as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _shard(of: Column, bits: int) -> Column:
    return F.shiftright(F.conv(F.hex(F.substring(of, 1, 4)), 16, 10).cast("long"), 32 - bits)


def _place(key: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest (rows of four 64-bit numbers) on a level of some size."""
    step = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(key[:, 1] + step * (key[:, 2] | np.uint64(1))) ^ key[:, 3]) % np.uint64(size)


def _keys(blob: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(blob).view("<u8")


def perfect_hash(blob: np.ndarray) -> tuple[list[bytes], list[int], np.ndarray]:
    """(bits of the levels, their sizes, order) of distinct digests, an array of n x 32 bytes;
    order lists the digests by slot."""
    key, left = _keys(blob), np.arange(len(blob))
    bits, sizes, order = [], [], []
    while len(left):
        size = max(8, int(len(left) * ROOM))
        at = _place(key[left], len(sizes), size).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        order.append(left[own][np.argsort(at[own])])
        bits.append(np.packbits(alone, bitorder="little").tobytes())
        sizes.append(size)
        left = left[~own]
    return bits, sizes, np.concatenate(order) if order else left


def slots(blob: np.ndarray, bits: list[bytes], sizes: list[int], held: np.ndarray) -> np.ndarray:
    """Slot of each digest of blob, -1 where held, the slots' digests, has none with all its bytes."""
    key, out = _keys(blob), np.full(len(blob), -1)
    left, before = np.arange(len(blob)), 0
    for level, (b, size) in enumerate(zip(bits, sizes)):
        is_set = np.unpackbits(np.frombuffer(b, np.uint8), count=size, bitorder="little")
        count = np.cumsum(is_set)
        at = _place(key[left], level, size).astype(np.int64)
        hit = is_set[at] > 0
        out[left[hit]] = before + count[at[hit]] - 1
        before += int(count[-1])
        left = left[~hit]
    met = np.flatnonzero(out >= 0)
    same = (held[out[met]] == blob[met]).all(1)
    out[met[~same]] = -1
    return out


def _blob(digests: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def shard_bits(spark, rows: int) -> int:
    """Bits that number the shards of so many digests."""
    return min(32, (max(rows // SHARD, SPREAD * partitions(spark)) - 1).bit_length())


def build(groups: DataFrame, bits: int) -> DataFrame:
    """The index of groups (digest, locator, n), whose digests are distinct: one row a shard.

    locator may have any type. Shards that no digest falls into have no row; an empty table
    gives an empty index.
    """

    def one(t: pa.Table) -> pa.Table:
        blob = _blob(t["digest"])
        level, size, order = perfect_hash(blob)
        whole = pa.array([0, len(order)], pa.int32())
        columns = {
            "shard": t["shard"][:1], "levels": pa.array([level], pa.list_(pa.binary())), "sizes": pa.array([size], pa.list_(pa.int32())),
            "digests": pa.array([blob[order].tobytes()], pa.binary()),
            "locators": pa.ListArray.from_arrays(whole, _one(t["locator"]).take(pa.array(order))), "counts": pa.ListArray.from_arrays(whole, _one(t["n"]).take(pa.array(order))),
        }
        return pa.table(columns)

    kind = groups.schema["locator"].dataType.simpleString()
    schema = f"shard long, levels array<binary>, sizes array<int>, digests binary, locators array<{kind}>, counts array<long>"
    return groups.select(_shard(F.col("digest"), bits).alias("shard"), "digest", "locator", "n").groupBy("shard").applyInArrow(one, schema)


def look_up(index: DataFrame, groups: DataFrame, bits: int) -> DataFrame:
    """All digests of the index and of groups, each once: digest; old, n_old of the index; new,
    n_new of groups. What one side doesn't have is null and 0."""

    def shard(left: pa.Table, right: pa.Table) -> pa.Table:
        new, blob = _one(right["locator"]), _blob(right["digest"])
        n_new = _one(right["n"]).to_numpy(zero_copy_only=False).astype(np.int64)
        if left.num_rows:
            held = np.frombuffer(left["digests"][0].as_py(), np.uint8).reshape(-1, WIDTH)
            old, n_old = left["locators"][0].values, left["counts"][0].values.to_numpy(zero_copy_only=False)
            at = slots(blob, left["levels"][0].as_py(), left["sizes"][0].as_py(), held)
        else:
            held, old, n_old, at = np.empty((0, WIDTH), np.uint8), new[:0], np.empty(0, np.int64), np.full(len(blob), -1)
        fresh, met = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        back = np.full(len(held), -1)
        back[at[met]] = met
        nobody = np.full(len(fresh), -1)
        of_old, of_new = np.concatenate([np.arange(len(held)), nobody]), np.concatenate([back, fresh])
        pick = lambda values, k: values.take(pa.array(k, mask=k < 0))
        count = lambda values, k: np.where(k < 0, 0, np.append(values, 0)[k])
        every = np.concatenate([held, blob[fresh]])
        data = pa.Array.from_buffers(pa.binary(), len(every), [None, pa.py_buffer(np.arange(len(every) + 1, dtype=np.int32) * WIDTH), pa.py_buffer(every.tobytes())])
        columns = {"digest": data, "old": pick(old, of_old), "n_old": pa.array(count(n_old, of_old)), "new": pick(new, of_new), "n_new": pa.array(count(n_new, of_new))}
        return pa.table(columns)

    kind = groups.schema["locator"].dataType.simpleString()
    dealt = groups.select(_shard(F.col("digest"), bits).alias("shard"), "digest", "locator", "n")
    return index.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(shard, f"digest binary, old {kind}, n_old long, new {kind}, n_new long")


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, locator, n) of rows (digest, locator): the greatest locator of each digest, and
    how many rows have it. Counted in the map step first, so that no group travels whole."""
    return rows.groupBy("digest").agg(F.max("locator").alias("locator"), F.count("*").alias("n"))


def merged(found: DataFrame) -> DataFrame:
    """look_up()'s result as groups: the greatest locator of both sides, and all rows."""
    return found.select("digest", F.greatest("old", "new").alias("locator"), (F.col("n_old") + F.col("n_new")).alias("n"))


def located(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(digest, locator) of every row, written: a locator is the id, a hash of the row and a
    number of its own, so that of several rows one is the greatest; null ids are the least."""
    every = F.xxhash64(*docs.columns)
    return written(docs.select(digest(F.col(text)).alias("digest"), F.struct(F.col(doc_id).alias("id"), every.alias("tie"), F.monotonically_increasing_id().alias("row")).alias("locator")))


def deduplicate(docs: DataFrame, history: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows of docs that stay, with their columns: those whose text history doesn't have, and of
    equal ones the row with the largest doc_id.

    history: groups of the batches before, by remember(). Null and empty texts are equal; of
    rows with equal ids or without one the greatest hash of all columns stays, of rows that
    are equal in all columns one. Texts may be of any length; only digests are shuffled, but
    for rows that are there several times. Empty tables give empty tables.
    """
    spark = docs.sparkSession
    rows = located(docs, text, doc_id)
    fresh = grouped(rows)
    if history is not None:
        bits = shard_bits(spark, history.count())
        index = written(build(history, bits))
        fresh = look_up(index, fresh, bits).where("n_old = 0").select("digest", F.col("new").alias("locator"), F.col("n_new").alias("n"))
    fresh = written(fresh.select("digest", F.col("locator.tie").alias("tie")))
    again = rows.groupBy("digest", F.col("locator.tie").alias("tie")).count().where("count > 1")
    d, t = unused(docs, "digest"), unused(docs, "tie")
    keyed = docs.withColumns({d: digest(F.col(text)), t: F.xxhash64(*docs.columns)})
    keys = lambda of: of.select(F.col("digest").alias(d), F.col("tie").alias(t))
    stay = keyed.join(keys(fresh), [d, t], "left_semi")
    once = stay.join(keys(again), [d, t], "left_anti")
    return once.unionByName(stay.join(keys(again), [d, t], "left_semi").dropDuplicates([d])).select(docs.columns)


def remember(docs: DataFrame, history: DataFrame | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Groups (digest, locator, n) of history and docs together, written; history of the next batch."""
    groups = grouped(located(docs, text, doc_id))
    if history is None:
        return written(groups)
    bits = shard_bits(docs.sparkSession, history.count())
    return written(merged(look_up(build(history, bits), groups, bits)))


def report(docs: DataFrame, earlier: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Rows with earlier (a condition on doc_id) are the history: their digests are indexed, and
    those of the others looked up in it. Groups span both. Null texts count as empty; of
    equal texts the row with the largest doc_id stays, null ids come last, and of rows with
    equal ids one is kept. Texts are read once, and only digests are shuffled; those that
    many rows have are joined by broadcast.
    """
    spark = docs.sparkSession
    rows = located(docs.select(doc_id, text), text, doc_id)
    of = rows.select("digest", "locator", F.coalesce(earlier, F.lit(False)).alias("earlier")) if earlier is not None else rows
    total = rows.count()
    bits = shard_bits(spark, total)
    index = written(build(grouped(of.where("earlier")), bits))
    groups = written(merged(look_up(index, grouped(of.where("not earlier")), bits)).withColumnRenamed("locator", "keep"))
    forget(index)
    out = hot_join(rows, groups, "digest", "n", total)
    return out.select(F.col("locator.id").alias("doc_id"), F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("locator.row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op11(spark, sf_dir: str) -> DataFrame:
    """The documents came in two deliveries, the lower and the upper half of the range of ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = None if low is None else (low + high) // 2
    return report(docs, F.col("locator.id") <= F.lit(middle))


OP11_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept, h AS text_sha256
FROM d
"""
