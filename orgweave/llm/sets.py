"""Shared by the set-similarity operators: candidates within runs, and exact verification.

A unit is a distinct line or passage, named by the 64-bit hash of its text. Candidate
links only span what may be similar; the connected components of the candidates are then
verified exactly, each on the sets of its own units: in one task up to LARGE units, and
pair by pair over the cluster beyond.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import partitions, written

#: Bits of a filter for each of its keys, and, as powers of 2, the least and most of them: the
#: largest filter has 64 MB. With more keys than it is made for, more others pass it.
BITS_A_KEY, FEWEST, MOST = 16, 16, 29
_CHUNKS = 64
#: Distinct units of a component that one task verifies; larger ones are verified by pairs.
LARGE = 50_000
#: Bytes of records that a bucket is meant to have, as estimated from the input.
BUCKET = 16 << 20


def buckets(spark, size: float) -> int:
    """Buckets for records of some bytes together: more for more data, so that one fits a task."""
    return max(partitions(spark), int(size / BUCKET) + 1)


def _bits(keys: np.ndarray, mask: int) -> list[np.ndarray]:
    u = keys.view(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64(mask)).astype(np.int64) for s in (0, 30)]


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bit array that has every key (a long) of the only column, sized by their number.

    Partitions' arrays are joined on the executors; the driver gets one of 64 MB at most.
    What others pass it costs time and changes no result.
    """
    power = min(MOST, max(FEWEST, int(keys.count() * BITS_A_KEY).bit_length()))
    whole, mask = (1 << power) // 8, (1 << power) - 1

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(whole, np.uint8)
        for b in batches:
            for k in _bits(b.iloc[:, 0].to_numpy(np.int64), mask):
                np.bitwise_or.at(bits, k >> 3, (1 << (k & 7)).astype(np.uint8))
        for k, x in enumerate(bits.reshape(_CHUNKS, -1)):
            if x.any():
                yield pd.DataFrame({"chunk": [k], "data": [x.tobytes()]})

    def join(g: pd.DataFrame) -> pd.DataFrame:
        data = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in g.data])
        return pd.DataFrame({"chunk": g.chunk[:1], "data": [data.tobytes()]})

    schema = "chunk int, data binary"
    out = np.zeros((_CHUNKS, whole // _CHUNKS), np.uint8)
    for r in keys.mapInPandas(mark, schema).groupBy("chunk").applyInPandas(join, schema).collect():
        out[r.chunk] = np.frombuffer(r.data, np.uint8)
    return out.reshape(-1)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys), bool)
    for k in _bits(keys, 8 * len(bits) - 1):
        out &= (bits[k >> 3] >> (k & 7)) & 1 > 0
    return out


class Spans:
    """Union-find over rows; links within a set are passed over."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _find(self, x: int) -> int:
        r = self.root
        while r[x] != x:
            r[x] = r[r[x]]
            x = r[x]
        return x

    def roots(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        far = self.root[i] != self.root[j]
        for a, b in zip(i[far].tolist(), j[far].tolist()):
            x, y = self._find(a), self._find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
        if len(i) > 1000 and far.any():  # later calls then pass over what is joined
            self.roots()


def similar(sets: list[np.ndarray], t: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leader, similar others) in order until no set is left that no leader is similar to.

    A leader is compared with all sets by exact Jaccard, at the cost of all elements once.
    A set similar to an earlier leader never leads, so a group of copies takes one round.
    Every set that is similar to an earlier one is told so: it follows an earlier leader, or
    leads and is compared with all. (Followers of different leaders may be similar too; see
    linked() for components.)
    """
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    _, at = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    begin = np.concatenate(([0], np.cumsum(size)))
    seen = np.zeros(int(at.max(initial=-1)) + 1, bool)
    done = np.zeros(len(sets), bool)
    for lead in range(len(sets)):
        if done[lead]:
            continue
        own = at[begin[lead] : begin[lead + 1]]
        seen[own] = True
        common = np.bincount(owner[seen[at]], minlength=len(sets))
        seen[own] = False
        hit = common * (1 + t) >= t * (size + size[lead]) - 1e-9
        hit[lead] = False
        done |= hit
        done[lead] = True
        yield lead, np.flatnonzero(hit)


def _small(sets: list[np.ndarray], t: float) -> Iterator[tuple[int, np.ndarray]]:
    """similar(), for a handful of sets."""
    own = [frozenset(s.tolist()) for s in sets]
    done = [False] * len(own)
    for lead, a in enumerate(own):
        if not done[lead]:
            hit = [k for k, b in enumerate(own) if k != lead and len(a & b) * (1 + t) >= t * (len(a) + len(b)) - 1e-9]
            for k in (lead, *hit):
                done[k] = True
            yield lead, np.array(hit, np.int64)


def verified(sets: list[np.ndarray], t: float) -> Iterator[tuple[int, np.ndarray]]:
    return _small(sets, t) if len(sets) <= 8 else similar(sets, t)


def linked(sets: list[np.ndarray], t: float) -> np.ndarray:
    """The least member, by number, of each set's component of the similarity graph; exact.

    A component grows from its least member: each member in turn is compared with the sets
    that no component has yet, so a group of copies is reached at once and the others of it
    only see what is left.
    """
    n = len(sets)
    label, open_, left = np.arange(n), np.ones(n, bool), n
    size = np.array([len(s) for s in sets])
    _, at = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate(([0], np.cumsum(size)))
    seen = np.zeros(int(at.max(initial=-1)) + 1, bool)
    owner, rest, held = np.repeat(np.arange(n), size), at, n
    for first in range(n):
        if not open_[first]:
            continue
        open_[first], left, front = False, left - 1, [first]
        while front and left:
            x = front.pop()
            if left < 0.75 * held:  # drop what is closed from the arrays
                keep = open_[owner]
                owner, rest, held = owner[keep], rest[keep], left
            own = at[begin[x] : begin[x + 1]]
            seen[own] = True
            common = np.bincount(owner[seen[rest]], minlength=n)
            seen[own] = False
            new = np.flatnonzero(open_ & (common * (1 + t) >= t * (size + size[x]) - 1e-9))
            open_[new] = False
            label[new] = first
            left -= len(new)
            front += new.tolist()
    return label


def runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by key, cut again so that no key's rows are parted."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[key].to_numpy()
        cut = int(np.searchsorted(k, k[-1]))
        if held and (cut or held[0][key].iloc[0] != k[0]):
            if not cut:  # one key fills this batch
                yield pd.concat(held, ignore_index=True)
                held = [b]
                continue
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
            held = [b.iloc[cut:]]
        elif cut:
            yield b.iloc[:cut].reset_index(drop=True)
            held = [b.iloc[cut:]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)


def bounds(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))


def large_components(members: DataFrame, large: int = LARGE) -> DataFrame:
    return members.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > large).select("component")


def overlaps(xs: list[bytes], ys: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, sizes, common elements) of pairs of sets, each given as the bytes of its elements."""
    one, two = np.frombuffer(b"".join(xs), dtype), np.frombuffer(b"".join(ys), dtype)
    width = np.dtype(dtype).itemsize
    n, m = (np.fromiter(map(len, z), np.int64, len(z)) // width for z in (xs, ys))
    pair = np.concatenate((np.repeat(np.arange(len(xs)), n), np.repeat(np.arange(len(ys)), m)))
    value = np.concatenate((one, two))
    order = np.lexsort((value, pair))
    pair, value = pair[order], value[order]
    both = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
    return n, m, np.bincount(pair[1:][both], minlength=len(xs))


def similar_pairs(pairs: DataFrame, sets: DataFrame, t: float, dtype) -> DataFrame:
    """The pairs (a, b) whose sets, of (key, data), have a Jaccard of t or more; exact."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, m, common = overlaps(list(b.x), list(b.y), dtype)
            yield b.loc[common * (1 + t) >= t * (n + m) - 1e-9, ["a", "b"]]

    of = lambda end, data: sets.select(F.col("key").alias(end), F.col("data").alias(data))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInPandas(check, "a long, b long")


def links_by_prefix(members: DataFrame, t: float, dtype, rank: Callable[[np.ndarray], np.ndarray], chain: bool, first: int = 4) -> DataFrame:
    """Verified links (src, dst), src the earlier one, within components of any size.

    members: component, key, data (a set as bytes), o (the order). Elements are ordered by
    rank, then value; similar units share one of the first |x| - ceil(t |x|) + 1 of each. In
    the run of an element, units stand by o, and each is compared with those just before it:
    the nearest `first`, then four times as many, and so on up to the whole run. With chain,
    only units of different components of the links so far are compared, so the links give
    the components of all similar pairs; without, only units that nothing before them was
    found similar to, so every unit with an earlier similar one is the dst of a link. A group
    of copies is done after the first round; rounds go by the logarithm of the longest run.
    """
    members = written(members.select("component", "key", "data", "o"))
    width = np.dtype(dtype).itemsize

    def prefix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            size = np.fromiter(map(len, b.data), np.int64, len(b)) // width
            flat, unit = np.frombuffer(b"".join(b.data), dtype), np.repeat(np.arange(len(b)), size)
            order = np.lexsort((flat, rank(flat), unit))
            pos = np.arange(len(flat)) - (np.cumsum(size) - size)[unit]
            k = np.flatnonzero(pos < (size - np.ceil(t * size - 1e-9) + 1)[unit])
            tok, u = flat[order[k]].astype(np.uint64).view(np.int64), unit[k]
            yield pd.DataFrame({"component": b.component.to_numpy()[u], "key": b.key.to_numpy()[u], "tok": tok, "pos": pos[k], "size": size[u]})

    records = members.select("component", "key", "data").mapInPandas(prefix, "component long, key long, tok long, pos long, size long")
    place = F.row_number().over(Window.partitionBy("component", "tok").orderBy("o", "key"))
    runs = written(records.join(members.select("key", "o"), "key").withColumn("rn", place).drop("o"))
    longest = runs.agg(F.max("rn")).first()[0] or 0
    links, near, far = None, 1, first + 1
    while near < longest:
        open_ = others = runs.withColumn("label", F.col("key"))
        if links is not None and chain:
            label = connected_components(links).select(F.col("node").alias("key"), F.col("component").alias("label"))
            told = runs.join(label, "key", "left").withColumn("label", F.coalesce("label", "key"))
            mixed = told.groupBy("component", "tok").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("component", "tok")
            open_ = others = written(told.join(mixed, ["component", "tok"], "left_semi"))
        elif links is not None:
            open_ = open_.join(links.select(F.col("dst").alias("key")).distinct(), "key", "left_anti")
        steps = F.sequence(F.lit(near), F.least(F.lit(far - 1), F.col("rn") - 1))
        later = open_.where(F.col("rn") > near).select("component", "tok", F.col("key").alias("b"), F.col("size").alias("m"), F.col("pos").alias("q"), F.col("label").alias("y"), "rn", F.explode(steps).alias("d"))
        later = later.withColumn("rn", F.col("rn") - F.col("d"))
        earlier = others.select("component", "tok", "rn", F.col("key").alias("a"), F.col("size").alias("n"), F.col("pos").alias("p"), F.col("label").alias("x"))
        left = 1 + F.least(F.col("n") - F.col("p") - 1, F.col("m") - F.col("q") - 1)
        fits = (F.least("n", "m") >= F.greatest("n", "m") * t - 1e-9) & (left >= F.ceil((F.col("n") + F.col("m")) * t / (1 + t) - 1e-9)) & (F.col("x") != F.col("y"))
        met = later.join(earlier, ["component", "tok", "rn"]).where(fits).select("a", "b").distinct()
        got = written(similar_pairs(met, members, t, dtype).select(F.col("a").alias("src"), F.col("b").alias("dst")))
        links = got if links is None else links.unionByName(got)
        near, far = far, 4 * far
    return members.select(F.col("key").alias("src"), F.col("key").alias("dst")).limit(0) if links is None else links
