"""Periodic runs of words: maximal stretches that repeat with a period, all of them.

The words of a batch of texts are ranked by their first 1, 2, 4, ... words until all suffixes
of a text differ, which gives the suffix array and, kept by level, the common prefix of any
two places. A place's longest previous factor is the longer of the common prefixes with the
next suffixes above and below that start earlier; the factors cut a text into blocks. A run
that touches a block's start or ends with the block is found by extending, for each period
that can occur there, a pair of equal words to both sides. A run inside a block has been
seen where the block's text stood before; such runs are copied from buckets by start.

A run of MIN_LENGTH words repeats MIN_LENGTH / 2 of them, so texts without a repeated window
of that size have none, and only the others are ranked.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table
from .tokens import mix

MIN_LENGTH = 12
#: Bytes of texts that are searched at once, and pairs of places that are extended at once.
BATCH, PAIRS = 2_000_000, 1_000_000
_INT = np.int32


class Suffixes:
    """Ranks by powers of two, suffix array and common prefixes of some texts in a row.

    word: a number for each word; begin: where each text starts, and the end of the last.
    """

    def __init__(self, word: np.ndarray, begin: np.ndarray):
        n = len(word)
        self.begin = begin
        self.doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        self.past = begin[1:][self.doc]
        key = self.doc * (int(word.max(initial=0)) + 1) + word
        order = np.argsort(key, kind="stable")
        ranks = np.empty(n, _INT)
        head = self._heads(key[order])
        ranks[order] = head
        self.ranks = [ranks]
        size, place = 1, np.arange(n)
        while True:
            tied = np.zeros(n, bool)
            tied[:-1] = head[1:] == head[:-1]
            tied[1:] |= tied[:-1]
            place = np.flatnonzero(tied)
            if not len(place):
                break
            at = order[place]
            follow = at + size
            inside = follow < self.past[at]
            by = np.where(inside, ranks[np.minimum(follow, n - 1)].astype(np.int64) + 1, 0)
            inner = np.argsort(ranks[at].astype(np.int64) * (n + 1) + by, kind="stable")
            at, by, old = at[inner], by[inner], head[place]
            order[place] = at
            new = np.ones(len(place), bool)
            new[1:] = (old[1:] != old[:-1]) | (by[1:] != by[:-1])
            head[place] = place[np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))]
            ranks = ranks.copy()
            ranks[at] = head[place]
            self.ranks.append(ranks)
            size *= 2
        self.order = order

    @staticmethod
    def _heads(key: np.ndarray) -> np.ndarray:
        """Index of the first of the equal keys of a sorted array."""
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(key)), 0)).astype(_INT)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i < j on are equal."""
        got, last = np.zeros(len(i), np.int64), len(self.doc) - 1
        for level in range(len(self.ranks) - 1, -1, -1):
            r = self.ranks[level]
            far = j + got
            same = (far < self.past[j]) & (r[np.minimum(i + got, last)] == r[np.minimum(far, last)])
            got[same] += 1 << level
        return got

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to before i < j are equal."""
        got, first = np.zeros(len(i), np.int64), self.begin[self.doc[j]]
        for level in range(len(self.ranks) - 1, -1, -1):
            r, back = self.ranks[level], got + (1 << level)
            near = i - back
            same = (near >= first) & (r[np.maximum(near, 0)] == r[np.maximum(j - back, 0)])
            got[same] += 1 << level
        return got

    def _earlier(self, step: int) -> np.ndarray:
        """For each place of the suffix array, the next place in a direction whose suffix starts
        earlier; -1 where there is none."""
        at = self.order[::step]
        n = len(at)
        least, width = [at], 1
        longest = int(np.diff(self.begin).max(initial=0))
        while width < longest:  # least[k][x]: the least of the 2**k entries up to x
            low = least[-1].copy()
            np.minimum(low[width:], least[-1][:-width], out=low[width:])
            least.append(low)
            width *= 2
        x = np.arange(n) - 1
        for k in range(len(least) - 1, -1, -1):
            skip = (x >= 0) & (least[k][np.maximum(x, 0)] > at)
            x[skip] -= 1 << k
        x = np.maximum(x, -1)
        return x if step == 1 else np.where(x >= 0, n - 1 - x, -1)[::-1]

    def previous_factors(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, start) of each place's longest factor that also starts earlier in its text;
        of equally long ones that of the suffix above."""
        length, start = np.zeros(len(self.doc), np.int64), np.full(len(self.doc), -1)
        for step in (1, -1):
            near = self._earlier(step)
            k = np.flatnonzero(near >= 0)
            own, other = self.order[k], self.order[near[k]]
            same = self.doc[own] == self.doc[other]
            own, other = own[same], other[same]
            size = self.ahead(other, own)
            more = size > length[own]
            length[own[more]], start[own[more]] = size[more], other[more]
        return length, start

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, source) of the blocks of all texts; source: where the block's text starts
        earlier, -1 for a word that is new."""
        length, start = self.previous_factors()
        at, i, n, size = [], 0, len(length), np.maximum(length, 1).tolist()
        while i < n:
            at.append(i)
            i += size[i]
        at = np.array(at, np.int64)
        return at, start[at]


def _spread(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number from 1) of n items for each owner."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + 1


def _slices(n: np.ndarray) -> Iterator[slice]:
    """Neighbouring owners of about PAIRS items."""
    edges = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()) + PAIRS, PAIRS)))
    edges = np.unique(np.concatenate(([0], edges, [len(n)])))
    return (slice(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()))


def _extended(s: Suffixes, word: np.ndarray, at: np.ndarray, period: np.ndarray, least: int) -> np.ndarray:
    """(start, end, period) of the runs with the pair of places at, at + period, as rows."""
    k = np.flatnonzero(word[at] == word[at + period])
    at, period = at[k], period[k]
    right = s.ahead(at, at + period)
    k = np.flatnonzero(right > 0)
    at, period, right = at[k], period[k], right[k]
    left = s.behind(at, at + period)
    equal = left + right
    k = np.flatnonzero(equal >= np.maximum(period, least - period))
    return np.stack([at[k] - left[k], at[k] + right[k] + period[k], period[k]], 1)


def touching(s: Suffixes, word: np.ndarray, start: np.ndarray, least: int) -> np.ndarray:
    """(start, end, period) of the runs that touch a block's start or end with a block; each
    once, with its smallest period."""
    doc = s.doc[start]
    new = np.ones(len(start), bool)
    new[1:] = doc[1:] != doc[:-1]
    end = np.where(np.append(new[1:], True), s.past[start], np.append(start[1:], 0))
    size = end - start
    before = np.where(new, 0, np.concatenate(([0], size[:-1])))
    first, found = s.begin[doc], [np.empty((0, 3), np.int64)]
    for k in _slices(size + before):
        owner, period = _spread((size + before)[k])
        at, past, low = start[k][owner], s.past[start[k]][owner], first[k][owner]
        ok = at + period < past
        found.append(_extended(s, word, at[ok], period[ok], least))
        ok = at - period >= low
        found.append(_extended(s, word, (at - period)[ok], period[ok], least))
    half = size // 2
    for k in _slices(half):
        owner, period = _spread(half[k])
        found.append(_extended(s, word, end[k][owner] - 1 - period, period, least))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    once = np.ones(len(runs), bool)
    once[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])
    return runs[once]


def copied(runs: list[tuple[int, int, int]], blocks: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """runs with those inside the blocks (start, end, source) of their text, by start and period."""
    bucket: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, j, p in runs:
        bucket[i].append((j, p))
    for start, end, source in blocks:
        if source < 0 or end - start < least + 2:
            continue
        back = start - source
        for i in range(start + 1, end - least):
            for j, p in bucket.get(i - back, ()):
                if j + back < end:
                    bucket[i].append((j + back, p))
    return sorted(((i, j, p) for i, of in bucket.items() for j, p in of), key=lambda r: (r[0], r[2]))


def _repeating(word: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    """Which texts may have a window of words twice: all that do, told by hash."""
    n = len(word) - window + 1
    out = np.zeros(len(begin) - 1, bool)
    if n <= 0:
        return out
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    h = mix(doc[:n].astype(np.uint64))
    for k in range(window):
        h = mix(h + word[k : k + n].astype(np.uint64))
    h = h[doc[window - 1 :] == doc[:n]]
    doc = doc[:n][doc[window - 1 :] == doc[:n]]
    order = np.argsort(h)
    out[doc[order[1:]][h[order[1:]] == h[order[:-1]]]] = True
    return out


def runs_of(texts: list[list], least: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, end, period), by start and period: stretches of
    least words or more, and two periods or more, with their smallest period, that no
    neighbouring word extends."""
    number = defaultdict(count().__next__).__getitem__
    out: list[list] = [[] for _ in texts]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    word = np.fromiter((number(w) for t in texts for w in t), np.int64, int(size.sum()))
    begin = np.concatenate(([0], np.cumsum(size)))
    some = np.flatnonzero(_repeating(word, begin, least - least // 2))
    if not len(some):
        return out
    word = np.concatenate([word[begin[k] : begin[k + 1]] for k in some.tolist()])
    begin = np.concatenate(([0], np.cumsum(size[some])))
    s = Suffixes(word, begin)
    start, source = s.blocks()
    runs = touching(s, word, start, least)
    end = np.append(start[1:], len(word))
    by_text = lambda at: np.searchsorted(at, begin).tolist()
    of_run, of_block = by_text(runs[:, 0]), by_text(start)
    for k, t in enumerate(some.tolist()):
        if of_run[k] == of_run[k + 1]:
            continue
        a, b, low = of_block[k], of_block[k + 1], int(begin[k])
        mine = runs[of_run[k] : of_run[k + 1]].tolist()
        blocks = zip(start[a:b].tolist(), end[a:b].tolist(), source[a:b].tolist())
        out[t] = [(i - low, j - low, p) for i, j, p in copied(mine, blocks, least)]
    return out


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """words without those that any run has after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for i, j, p in runs:
        edge[i + p] += 1
        edge[j] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def _batches(texts: pa.Array) -> Iterator[list[bytes]]:
    """Neighbouring texts of about BATCH bytes, null as empty; at least one run."""
    held, size = [], 0
    for x in texts:
        t = x.as_py() or b""
        held.append(t)
        size += len(t)
        if size >= BATCH:
            yield held
            held, size = [], 0
    if held or not len(texts):
        yield held


_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(docs: DataFrame, text: str | Column = "text", out: str = "periodic", least: int = MIN_LENGTH) -> DataFrame:
    """docs with a struct: n_words; runs (start, length, period; words numbered from 0), by start
    and period; collapsed, the words that no run repeats, joined by blanks.

    Words are what blanks, tabs and line ends part. Runs have least words and two periods or
    more. Null, empty and wordless texts have no words, no runs and an empty collapsed
    text. Texts of any length are searched whole; repeated rows have equal results, an empty
    table gives an empty one. A column of the input called as out is replaced, others stay.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            for raw in _batches(s):
                words = [t.split() for t in raw]
                found = runs_of(words, least)
                flat = np.array([(i, j - i, p) for of in found for i, j, p in of], np.int64).reshape(-1, 3)
                at = np.concatenate(([0], np.cumsum([len(of) for of in found]))).astype(np.int32)
                each = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                left = pa.array([b" ".join(collapsed(w, of)) for w, of in zip(words, found)], pa.binary()).cast(pa.string())
                yield pa.StructArray.from_arrays([pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(pa.array(at), each), left], ["n_words", "runs", "collapsed"])

    column = F.col(text) if isinstance(text, str) else text
    return docs.withColumn(out, F.arrow_udf(run, _FOUND).asNondeterministic()(column.cast("binary")))


def with_periodic_tail(text: Column, doc_id: Column) -> Column:
    """The words of one text in ten, picked by the hash of its id, repeated with a period from
    some word on to the end; other texts as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1))  # a text without words stays as it is
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    times = F.floor((n - a) / p).cast("int")
    joined = lambda start, size: F.array_join(F.slice(words, start + 1, size), " ")
    repeated = F.repeat(F.concat(joined(a, p), F.lit(" ")), times)
    tail = F.concat_ws(" ", joined(F.lit(0), a), repeated, joined(a, (n - a) - times * p))
    return F.when((h % 10 == 0) & (F.size(words) > 0), tail).otherwise(text)


def op13(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs.select("doc_id", with_periodic_tail(F.col("text"), F.col("doc_id")).alias("text"))).select("doc_id", "periodic.*")
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines"), "collapsed")
    length, period = F.col("b.length"), -F.col("b.period")
    return found.select(
        "doc_id", "n_runs", (-F.col("b.start")).alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * b.length div (-b.period)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
