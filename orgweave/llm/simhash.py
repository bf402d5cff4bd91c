"""SimHash near-duplicates, linked through the anchors of a covering code.

Fingerprints are compared only where they meet at an anchor. The anchors are the code
words of the perfect Hamming(31, 26) code, applied to 31 bits of either half of the
fingerprint: its covering radius is 1, so every value lies within 1 of just one code
word, its home. Two fingerprints that differ in at most 3 of 64 bits differ in at most 1
bit in one of the halves; there each lies within 1 + 1 of the other's home. So each
fingerprint is sent to every anchor within radius plus threshold (16 a half at most) and
compared per anchor on all 64 bits. No link is lost and buckets are selected by 2**26.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import hot_join, partitions, written
from .tokens import _LOWER

LIMIT = 3
_hash = partial(xxhash.xxh64_intdigest, seed=42)
_POS = np.arange(1, 32, dtype=np.int64)


def fingerprint(text: str | None, size: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a text; 0 without words."""
    w = (text or "").encode().translate(_LOWER).split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(size)))) if len(w) >= size else [b" ".join(w)]
    n = max(1, len(w) - size + 1)
    ones, step = np.zeros(64, np.int64), 1 << 16
    h = np.fromiter(map(_hash, grams), np.uint64, n)
    for i in range(0, n, step):
        ones += np.unpackbits(h[i : i + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """docs' (doc_id, rk, fp, *keep): rk is xxhash64 of the text, fp the fingerprint as a signed
    long; null and empty texts have 0. Whole texts, however long, are read."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.array([fingerprint(t) for t in s], np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("rk"), fp(F.col(text)).alias("fp"), *keep)


def _syndrome(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), np.int64)
    for p in _POS:
        s ^= np.where((x >> (p - 1)) & 1, p, 0)
    return s


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, home): every anchor within radius 1 plus threshold 1, in either half."""
    out = []
    u = fp.view(np.uint64)
    for half in (0, 1):
        x = ((u >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        s, rows = _syndrome(x), np.arange(len(x))
        home = np.where(s > 0, x ^ (1 << np.maximum(s - 1, 0)), x)
        out.append((home | (half << 40), rows, np.ones(len(x), bool)))
        for p in _POS:  # flip the pair (p, p ^ s) once, where both are positions
            q = p ^ s
            k = np.flatnonzero((s > 0) & (q > p))
            out.append(((x[k] ^ (1 << (p - 1)) ^ (1 << (q[k] - 1))) | (half << 40), rows[k], np.zeros(len(k), bool)))
    return tuple(map(np.concatenate, zip(*out)))


def _near(key: np.ndarray, fp: np.ndarray, home: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is linked within each run of equal keys; keys are sorted."""
    cutat = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cutat)
    left, right = [], []
    short = np.repeat(size <= 12, size)
    for d in range(1, 12):
        i = np.flatnonzero((key[d:] == key[:-d]) & short[d:] & (home[d:] | home[:-d]))
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= limit]
        left.append(fp[i])
        right.append(fp[i + d])
    for r in np.flatnonzero(size > 12):  # each member is taken out by the first that reaches it
        rest = np.unique(fp[cutat[r] : cutat[r + 1]])
        todo: list = []
        while len(rest) or todo:
            if not todo:
                todo, rest = [rest[0]], rest[1:]
            x = todo.pop()
            hit = np.bitwise_count(rest ^ x) <= limit
            found, rest = rest[hit], rest[~hit]
            left.append(np.full(len(found), x))
            right.append(found)
            todo.extend(found)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (src, dst) between distinct fingerprints, enough to join all that are linked.

    fps: one column fp of distinct signed longs, none null; an empty table has no links. Each
    is replicated to 16 anchors a half on average, among 2**26 a half: beyond some 10**10
    fingerprints an anchor has many, and comparing them grows with their square. Within an
    anchor the links that are given span what is linked there; the others would join nothing
    further.
    """

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = b.fp.to_numpy(np.int64)
            for i in range(0, len(v), 20_000):
                x = v[i : i + 20_000]
                a, row, home = anchors(x)
                yield pd.DataFrame({"anchor": a, "fp": x[row], "home": home})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for b in batches:
            held.append(b)
            whole = pd.concat(held) if len(held) > 1 else b
            key = whole.anchor.to_numpy()
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if done:
                yield pairs(whole.iloc[:done])
                whole = whole.iloc[done:]
            held = [whole]
        if held:
            yield pairs(pd.concat(held))

    def pairs(x: pd.DataFrame) -> pd.DataFrame:
        a, b = _near(x.anchor.to_numpy(), x.fp.to_numpy(), x.home.to_numpy(), limit)
        return pd.DataFrame({"src": a, "dst": b}).drop_duplicates()

    n = partitions(fps.sparkSession)
    met = fps.select("fp").mapInPandas(spread, "anchor long, fp long, home boolean").repartition(n, "anchor")
    return met.sortWithinPartitions("anchor").mapInPandas(compare, "src long, dst long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: doc_id, rk (xxhash64 of the text), fp (signed long),
    component (a fingerprint that names the group), component_id and the columns of keep.

    component_id is the smallest doc_id that the row can reach by links of at most limit
    differing bits, its own included. Equal fingerprints are linked; null, empty and blank
    texts have fingerprint 0 and are linked like any other. A null doc_id keeps its row
    and never is a component_id unless all of its component are null. Repeated rows stay.
    Texts may be of any length, ids of any type that has an order; an empty table gives an
    empty one. Other columns, whatever their names, are not returned. Exact copies collapse
    to one fingerprint before anything is replicated; a fingerprint that many rows share is
    met by broadcast.
    """
    fps = written(fingerprints(docs, doc_id, text, keep))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    comp = connected_components(links(least.select("fp"), limit))
    of = least.join(comp, least.fp == comp.node, "left").select("fp", "first", "rows", F.coalesce("component", "fp").alias("c"))
    smallest = of.groupBy("c").agg(F.min("first").alias("component_id"))
    named = written(of.join(smallest, "c").select("fp", "rows", F.col("c").alias("component"), "component_id"))
    return hot_join(fps, named, "fp", "rows", fps.count()).select("doc_id", "rk", "fp", "component", "component_id", *keep)


def op6(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
