"""Exact set-similarity join: classes of equal sets, prefix and count filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import forget, written
from .hot import join_counted


def least_common(n: Column, m: Column, least: float) -> Column:
    """Elements that sets of n and m must share for a Jaccard of least."""
    return F.ceil((n + m) * least / (1 + least) - 1e-9)


def classes(sets: DataFrame, key: str, words: str, block: tuple[str, ...] = ()) -> DataFrame:
    """(rep, n_members, w, *block): one row for each distinct set of a block, named by its
    least key. Sets are told apart by sha256 of their sorted words; empty sets are left out."""
    d = sets.select(F.col(key).alias("k"), F.sort_array(words).alias("w"), *block)
    same = F.sha2(F.to_json("w"), 256)
    # empty sets go last: a filter before would be put below the words and work them out twice
    return d.groupBy(*block, same.alias("set")).agg(F.min("k").alias("rep"), F.count("*").alias("n_members"), F.first("w").alias("w")).drop("set").where(F.size("w") > 0)


def members(sets: DataFrame, key: str, words: str, block: tuple[str, ...] = ()) -> DataFrame:
    """(key, rep): every key with the least key that has the same set in its block, written."""
    alike = F.to_json(F.struct(*block, F.sort_array(words).alias("words of the set")), {"ignoreNullFields": "false"})
    d = written(sets.select(F.col(key).alias("key"), F.unhex(F.sha2(alike, 256)).alias("set")))
    least = written(d.groupBy("set").agg(F.min("key").alias("rep"), F.count("*").alias("n")))
    out = written(join_counted(d, least, "set", "n", d.count()).select("key", "rep"))
    forget(d, least)
    return out


def by_rarity(sets: DataFrame, key: str, words: str, *also: str) -> DataFrame:
    """(key, o, n, *also), written: words as 64-bit hashes, the rarest first, ties by hash, and
    their number; the order is the same for all sets. Frequencies are counted over all of
    them, and a word that most sets have is joined where they stand."""
    d = written(sets.select(key, *also, F.transform(words, lambda x: F.xxhash64(x)).alias("h")))
    t = d.select(key, *also, F.explode("h").alias("t"))
    often = written(t.groupBy("t").agg(F.count("*").alias("df")))
    total = often.agg(F.sum("df")).first()[0] or 0
    o = join_counted(t, often, "t", "df", total).groupBy(key, *also).agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("o"))
    out = written(o.select(key, *also, F.transform("o", lambda x: x["t"]).alias("o"), F.size("o").alias("n")))
    forget(d, often)
    return out


def keys_of(first: Column, both: int) -> Column:
    """array<struct<t, u, pos>> of what sets meet on: the words t of first (u is 0), or with
    both = 2 its pairs t, u in order; pos counts from 0 and is that of the last word.

    Sets that share k words share both of them among the first n - k + both of each.
    """
    if both == 1:
        return F.transform(first, lambda x, i: F.struct(x.alias("t"), F.lit(0).cast("bigint").alias("u"), i.alias("pos")))
    pair = lambda x, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda y, j: F.struct(x.alias("t"), y.alias("u"), (i + j + 1).alias("pos")))
    return F.flatten(F.transform(first, pair))


def similar_sets(sets: DataFrame, key: str, words: str, least: float, block: tuple[str, ...] = ()) -> DataFrame:
    """(a, b, jaccard, n_a, n_b): the pairs a < b of different sets of a block with Jaccard of
    at least `least`, each set named by its least key; n_a and n_b are their members.

    words is an array without repeats. Equal sets are one (see members()), so copies aren't
    paired with each other. Words are ordered by rarity; two sets that are similar share one
    among the first n - ceil(least * n) + 1 of each, so pairs meet on a rare word, within the
    block, where sizes and positions still allow the overlap; the sets are joined back to
    what is left, as 64-bit hashes.
    """
    reps = classes(sets, key, words, block)
    d = by_rarity(reps, "rep", "w", "n_members", *block)
    p = d.select("rep", "n", *block, F.posexplode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))).alias("pos", "t"))
    a = p.select(F.col("rep").alias("a"), F.col("n").alias("an"), F.col("pos").alias("ap"), "t", *block)
    b = p.select(F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("pos").alias("bp"), "t", *block)
    sizes = F.least("an", "bn") >= F.greatest("an", "bn") * least - 1e-9
    left = 1 + F.least(F.col("an") - F.col("ap") - 1, F.col("bn") - F.col("bp") - 1)
    fits = (F.col("a") < F.col("b")) & sizes & (left >= least_common(F.col("an"), F.col("bn"), least))
    met = a.join(b, ["t", *block]).where(fits).select("a", "b").distinct()
    one = d.select(F.col("rep").alias("a"), F.col("o").alias("ao"), F.col("n_members").alias("n_a"))
    two = d.select(F.col("rep").alias("b"), F.col("o").alias("bo"), F.col("n_members").alias("n_b"))
    common = F.size(F.array_intersect("ao", "bo"))
    out = met.join(one, "a").join(two, "b").withColumn("jaccard", common / (F.size("ao") + F.size("bo") - common))
    return out.where(F.col("jaccard") >= least - 1e-12).select("a", "b", "jaccard", "n_a", "n_b")


#: Words of the sets that one task compares with each other; larger blocks are cut into tiles.
TILE = 24_000_000
#: A shorter set counts as one of so many words, as tasks also work for each pair of sets.
_SHORT = 64
#: Cells of the table of common words that a task counts at once.
_CELLS = 4_000_000


def _tiled(reps: DataFrame, sets: DataFrame, words: str, block: tuple[str, ...], most: int) -> DataFrame:
    """reps with chunk, and tile_i <= tile_j: a block of up to `most` words is one tile. The sets
    of a larger one are dealt to chunks by hash, and any two chunks are a tile."""
    size = F.sum(F.greatest(F.size(words), F.lit(_SHORT)))
    g = F.when(size > most, F.ceil(2 * size / most)).otherwise(1).cast("int")
    if block:
        d = reps.join(sets.groupBy(*block).agg(g.alias("tiles")), list(block))  # sets without a block meet none
    else:
        d = reps.crossJoin(F.broadcast(sets.agg(g.alias("tiles"))))
    d = d.withColumn("chunk", F.pmod(F.xxhash64("rep"), "tiles").cast("int"))
    d = d.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return d.withColumn("tile_i", F.least("chunk", "with")).withColumn("tile_j", F.greatest("chunk", "with"))


def _gathered(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of n numbers each, one after the other."""
    return np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)


def _similar_in(sets: list[np.ndarray], chunk: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, common): the pairs i < j of sets (64-bit hashes, none empty or with repeats) with a
    Jaccard of `least` or more, of different chunks if there are several.

    Words are ordered by rarity, and sets meet on what is rarest of either. Up to where the
    rarest of one of them end, all they have in common is counted; behind it are as many at
    most as the smaller rest has.
    """
    n = np.array([len(x) for x in sets])
    at = np.concatenate(([0], np.cumsum(n)))
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(often))
    base = np.arange(len(sets)) * len(often)
    key = np.sort(np.repeat(base, n) + rank[code])
    code = (key - np.repeat(base, n)).astype(np.int32)
    first = n - np.ceil(n * least - 1e-9).astype(np.int64) + 1
    last, rest = code[at[:-1] + first - 1], n - first

    rare = code[_gathered(at[:-1], first)]
    order = np.argsort(rare, kind="stable")  # sets of a word by number
    held = np.repeat(np.arange(len(sets), dtype=np.int32), first)[order]
    place = np.empty(len(rare), np.int64)
    place[order] = np.arange(len(rare))
    past = np.searchsorted(rare[order], np.arange(len(often)), "right")
    rare_at = np.concatenate(([0], np.cumsum(first)))
    several, seen = len(np.unique(chunk)) > 1, np.zeros(len(often), bool)

    step = max(1, _CELLS // len(sets))
    for lo in range(0, len(sets), step):
        hi = min(lo + step, len(sets))
        own = slice(rare_at[lo], rare_at[hi])
        after = place[own] + 1  # only later sets of a word
        count = past[rare[own]] - after
        row = np.repeat(np.repeat(np.arange(hi - lo) * len(sets), first[lo:hi]), count)
        row += held[_gathered(after, count)]
        common = np.bincount(row, minlength=(hi - lo) * len(sets)).astype(np.int32)
        met = np.flatnonzero(common)
        i, j, c = met // len(sets) + lo, met % len(sets), common[met]
        need = np.ceil((n[i] + n[j]) * least / (1 + least) - 1e-9)
        ok = (np.minimum(n[i], n[j]) >= need) & (c + np.where(last[i] <= last[j], rest[i], rest[j]) >= need)
        if several:
            ok &= chunk[i] != chunk[j]
        i, j, c, need = i[ok], j[ok], c[ok], need[ok]
        end = np.minimum(last[i], last[j])
        behind = np.minimum(*(at[x + 1] - np.searchsorted(key, base[x] + end, "right") for x in (i, j)))
        ok = c + behind >= need
        i, j, need = i[ok], j[ok], need[ok]
        ends = np.flatnonzero(np.diff(i, prepend=-1, append=-1))
        for x, y in zip(ends[:-1], ends[1:]):
            k, own = j[x:y], code[at[i[x]] : at[i[x] + 1]]
            seen[own] = True
            both = np.add.reduceat(seen[code[_gathered(at[k], n[k])]], np.concatenate(([0], np.cumsum(n[k])[:-1])), dtype=np.int64)
            seen[own] = False
            hit = both >= need[x:y]
            yield np.full(hit.sum(), i[x]), k[hit], both[hit]


def similar_long_sets(sets: DataFrame, key: str, words: str, least: float, block: tuple[str, ...] = (), most: int = TILE) -> DataFrame:
    """What similar_sets() gives, for sets of whole texts in blocks, which have so many words in
    common that all words and candidates would take several times the disk of the texts.

    The sets of a block are sent once, as 64-bit hashes, to the task
    that compares them, and no candidates are; a block of more than `most` words, to one
    task for any two of its chunks.
    """
    reps = classes(sets, key, words, block).withColumn("w", F.transform("w", lambda x: F.xxhash64(x)))
    kind = dict(reps.dtypes)["rep"]

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        rep, members, chunk = g.rep.to_numpy(), g.n_members.to_numpy(), g.chunk.to_numpy()
        if g.tile_i.iloc[0] != g.tile_j.iloc[0] and len(np.unique(chunk)) < 2:
            found = []
        else:
            found = list(_similar_in(list(g.w), chunk, least))
        i, j, both = (np.concatenate([x[k] for x in found] or [np.empty(0, np.int64)]) for k in range(3))
        n = g.w.map(len).to_numpy()
        return pd.DataFrame({"x": rep[i], "y": rep[j], "n_x": members[i], "n_y": members[j], "common": both, "every": n[i] + n[j] - both})

    tiles = _tiled(reps, sets, words, block, most).select("rep", "n_members", "w", "chunk", "tile_i", "tile_j", *block)
    found = tiles.groupBy(*block, "tile_i", "tile_j").applyInPandas(compare, f"x {kind}, y {kind}, n_x long, n_y long, common long, every long")
    up = F.col("x") < F.col("y")
    out = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (F.col("common") / F.col("every")).alias("jaccard"), F.when(up, F.col("n_x")).otherwise(F.col("n_y")).alias("n_a"), F.when(up, F.col("n_y")).otherwise(F.col("n_x")).alias("n_b"))
    return out.where(F.col("jaccard") >= least - 1e-12)
