"""Language-model scores from a class-based bigram model with exchange clustering.

P(w | previous) = P(class of w | class of previous) * P(unit of w | class) * P(w | unit).
Every word that training has LEAST times is clustered; rarer and unknown words belong to
the unit of their ending, so that all words have a class. Counts are taken over all
training documents. An unknown word has its share of the unit's words never seen, times
the probability of its spelling among all words of that ending: a chain of bytes, each
given the one before, counted over all training words. So all unknown words of an ending
add up to that share, however many there are. Exchange clustering of the most frequent words and the endings seeds
the classes. Every other clustered word is then placed in rounds over the cluster: its
neighbours are counted by class, and it moves to the class that raises the likelihood of
the class bigrams most.

Texts are dealt to blocks and read once: a block numbers its words as it meets them, and
its texts are written as lists of these numbers. Words are told apart by 64-bit hashes; a
block asks each hash bucket for the counts and classes of just the words it has, and is
counted and scored with that dictionary. So no task holds the vocabulary and nothing that
grows is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, forget, let_go, partitions, place as scratch, remove, small_batches, table, written
from .tokens import _BASE, _TABLE, BLANKS, U, Batch, mix, pieces, text_list, words

END = np.uint64(0x5851F42D4C957F2D)
#: Words that seed the classes, units of endings, classes, sweeps of the exchange.
CORE, SHAPES, CLASSES, SWEEPS = 512, 64, 48, 12
#: Training count from which a word has a class of its own, and rounds that place words.
LEAST, ROUNDS = 3, 2
UNITS = CORE + SHAPES + 1
#: A word as a block asks for it: its hash, training count and ending, and the block's number
#: for it; and as a bucket answers. Of words seen less than LEAST times, which are most, only
#: number and ending and count are told.
_WORD = np.dtype([("h", "<u8"), ("n", "<u4"), ("id", "<u4"), ("shape", "u1")])
_TOLD = np.dtype([("h", "<u8"), ("n", "<i8"), ("id", "<u4"), ("shape", "u1")])
_RARE = np.dtype([("id", "<u4"), ("shape", "u1")])
#: A word that its block doesn't teach, and log10 of its spelling's probability.
_SPELLED = np.dtype([("id", "<u4"), ("p", "<f4")])
#: Slots of a word's neighbours: classes after it, classes before it, itself.
SLOTS = 2 * CLASSES + 1
_MANY = np.dtype([("at", "<u4"), ("n", "<u4")])


def _shapes(b: Batch) -> np.ndarray:
    """Unit of each word's ending: its last three bytes, hashed."""
    start = np.maximum(b.start, b.end - 3)
    return (b.hashes(start, b.end) >> np.uint64(20)).astype(np.int64) % SHAPES


def _pairs_of(b: Batch) -> np.ndarray:
    """For each byte of the batch: the one before and itself, blanks as 0x20."""
    s = np.where(BLANKS[b.buf], 32, b.buf).astype(np.int64)
    return np.concatenate(([32], s[:-1])) * 256 + s


def spelling(docs: DataFrame, text: str = "text") -> np.ndarray:
    """log10 P(byte | byte before) over the words of docs, one added to each count; 0x20 is
    before a word's first byte and after its last one. What is collected are 65,536 counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(1 << 16, np.int64)
        for g in batches:
            for _, part in pieces(text_list(g.text)):
                n += np.bincount(_pairs_of(words(part, BLANKS)), minlength=1 << 16)
        k = np.flatnonzero(n)
        yield pd.DataFrame({"pair": k, "n": n[k]})

    got = docs.select(F.col(text).alias("text")).mapInPandas(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(1 << 16)
    n[got.pair.to_numpy(np.int64)] = got.n.to_numpy(float)
    n = n.reshape(256, 256) + 1
    other = BLANKS & (np.arange(256) != 32)
    n[other], n[:, other], n[32, 32] = 0, 0, 0
    with np.errstate(divide="ignore"):
        p = np.log10(n / np.maximum(n.sum(1, keepdims=True), 1))
    p[32, 32] = 0  # between blanks nothing is spelled
    return p


def endings(spelled: np.ndarray) -> np.ndarray:
    """log10 of the share of all spellings that belongs to each unit of endings, exactly:
    words of one byte, of two, and the last three bytes of all others."""
    b = np.flatnonzero(~BLANKS)
    step, first, last = 10 ** spelled[np.ix_(b, b)], 10 ** spelled[32, b], 10 ** spelled[b, 32]
    visits = np.linalg.solve(np.eye(len(b)) - step.T, first)
    h, base = _TABLE[b], U(_BASE)
    of = lambda x: (mix(x) >> U(20)).astype(np.int64) % SHAPES
    share = np.bincount(of(h), first * last, SHAPES)
    share += np.bincount(of(h[:, None] + h * base).ravel(), (first[:, None] * step * last).ravel(), SHAPES)
    two, end = h[:, None] * base + h * base * base, step * last
    for k in range(len(b)):
        share += np.bincount(of(h[k] + two).ravel(), (visits[k] * step[k][:, None] * end).ravel(), SHAPES)
    return np.log10(share)


def _tokens(texts: list) -> tuple[np.ndarray, np.ndarray, Batch, np.ndarray]:
    """(hash, text) of every token: words, then one end for each text; words, where ends go in."""
    b = words(texts, BLANKS)
    at = np.searchsorted(b.doc, np.arange(len(texts)), "right")
    return np.insert(b.hashes(), at, END), np.insert(b.doc, at, np.arange(len(texts))), b, at


def _block(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    """Rows with their block; copies of a row that come from different partitions are parted."""
    k = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.col(text), F.spark_partition_id()), F.lit(n)).cast("int")
    learn = F.coalesce(fold(F.col(doc_id), 7) != 2, F.lit(False))
    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"), learn.alias("learn"), k.alias("block"))


class _Numbers:
    """The words of a block in the order of their numbers: hashes, training counts, endings, spellings."""

    def __init__(self):
        self.h, self.n, self.shape = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint8)
        self.sorted, self.ids, self.spelled = self.h, np.empty(0, np.int64), np.empty(0, np.float32)

    def add(self, h: np.ndarray, shape: np.ndarray, learn: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Numbers of some tokens."""
        u, first, inv = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.sorted, u)
        old = at < len(self.sorted)
        old[old] = self.sorted[at[old]] == u[old]
        of = np.empty(len(u), np.int64)
        of[old], new = self.ids[at[old]], np.flatnonzero(~old)
        of[new] = np.arange(len(self.h), len(self.h) + len(new))
        self.h, self.shape, self.n = np.append(self.h, u[new]), np.append(self.shape, shape[first[new]].astype(np.uint8)), np.append(self.n, np.zeros(len(new), np.int64))
        self.spelled = np.append(self.spelled, spelled[first[new]].astype(np.float32))
        self.sorted, self.ids = np.insert(self.sorted, at[new], u[new]), np.insert(self.ids, at[new], of[new])
        self.n[of] += np.bincount(inv, learn, len(u)).astype(np.int64)
        return of[inv]


def _planes(ids: np.ndarray) -> bytes:
    """Numbers by the places of their bytes, so that the high ones, mostly equal, compress."""
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _packed_spelling(new: np.ndarray, p: np.ndarray) -> bytes:
    """Number of words, a bit for each that tells the new ones, and what their spellings have."""
    return np.uint32(len(new)).tobytes() + np.packbits(new).tobytes() + _planes(p[new])


def _unpacked_spelling(data: bytes) -> np.ndarray:
    size = int(np.frombuffer(data, "<u4", 1)[0])
    past = 4 + (size + 7) // 8
    ids = np.flatnonzero(np.unpackbits(np.frombuffer(data[4:past], np.uint8), count=size))
    out = np.empty(len(ids), _SPELLED)
    out["id"], out["p"] = ids, np.frombuffer(data[past:], np.uint8).reshape(4, -1).T.copy().view("<f4").reshape(-1)
    return out


def _read(n: int, spelled: np.ndarray):
    """Texts as numbers (bucket -1), the words of each block, a blob for each hash bucket, and
    the probability of the spellings of those that the block doesn't teach (bucket -2)."""
    flat = spelled.reshape(-1)

    def spell(b: Batch, ends: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(flat[_pairs_of(b)])))
        return np.insert(sums[b.end + 1] - sums[b.start], ends, 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, _Numbers] = {}
        for b in batches:
            for block, g in b.groupby("block"):
                numbers = held.setdefault(int(block), _Numbers())
                learn = g.learn.to_numpy(bool)
                for at, part in pieces(text_list(g.text)):
                    h, doc, words_, ends = _tokens(part)
                    ids = numbers.add(h, np.insert(_shapes(words_), ends, 0), learn[at : at + len(part)][doc], spell(words_, ends)).astype("<u4")
                    cut = np.searchsorted(doc, np.arange(len(part) + 1))
                    data = [_planes(ids[i:j]) for i, j in zip(cut[:-1].tolist(), cut[1:].tolist())]
                    rows = g.iloc[at : at + len(part)]
                    yield pd.DataFrame({"block": int(block), "bucket": -1, "doc_id": rows.doc_id.to_numpy(object), "learn": rows.learn.to_numpy(bool), "data": data})
        for block, numbers in held.items():
            e = np.empty(len(numbers.h), _WORD)
            e["h"], e["n"], e["id"], e["shape"] = numbers.h, numbers.n, np.arange(len(e)), numbers.shape
            bucket = (e["h"] % np.uint64(n)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(n + 1))
            full = np.flatnonzero(np.diff(ends))
            yield pd.DataFrame({"block": block, "bucket": full, "doc_id": None, "learn": False, "data": [e[order[ends[k] : ends[k + 1]]].tobytes() for k in full]})
            yield pd.DataFrame({"block": block, "bucket": [-2], "doc_id": None, "learn": False, "data": [_packed_spelling(numbers.n == 0, numbers.spelled)]})

    return run


def _count_bucket(g: pd.DataFrame) -> pd.DataFrame:
    """Answers for the blocks (kind 0), and the bucket's summary: sums (1), top words (2),
    words seen once (3) and tokens of unclustered words (4) by ending."""
    parts = [np.frombuffer(x, _WORD) for x in g.data]
    a = np.concatenate(parts)
    h, first, inv = np.unique(a["h"], return_index=True, return_inverse=True)
    total = np.bincount(inv, a["n"], len(h)).astype(np.int64)
    shape = a["shape"][first].astype(np.int64)
    rows, at = [], 0
    for block, p in zip(g.block, parts):
        n = total[inv[at : at + len(p)]]
        at += len(p)
        few = (n < LEAST) & (p["h"] != END)
        r, q = np.empty(int((~few).sum()), _TOLD), np.empty(int(few.sum()), _RARE)
        r["h"], r["n"], r["id"], r["shape"] = p["h"][~few], n[~few], p["id"][~few], p["shape"][~few]
        q["id"], q["shape"] = p["id"][few], p["shape"][few] + SHAPES * n[few]
        rows += [(0, int(block), 0, 0, r.tobytes()), (0, int(block), 1, 0, q[np.argsort(q["id"])].tobytes())]
    known = total > 0
    rows += [(1, 0, 0, int(known.sum()), b""), (1, 0, 1, int(total.sum()), b"")]
    top = np.lexsort((h, -total))[:CORE]
    rows += [(2, 0, int(h[k].view(np.int64)), int(total[k]), b"") for k in top if total[k] >= LEAST]
    once = np.bincount(shape[total == 1], minlength=SHAPES)
    rows += [(3, 0, s, int(once[s]), b"") for s in np.flatnonzero(once)]
    few = (total < LEAST) & (h != END)
    few = np.bincount(shape[few], total[few], SHAPES).astype(np.int64)
    rows += [(4, 0, s, int(few[s]), b"") for s in np.flatnonzero(few)]
    return pd.DataFrame(rows, columns=["kind", "block", "key", "n", "data"])


@dataclass
class Model:
    """core: sorted hashes of the words that are units; of: class of each unit; move:
    log10 P(class | class); emit: log10 P(unit | class of the unit); whole: log10 of each
    class's tokens, smoothed, by which a placed word's count is divided; rest: log10 of
    (1 - unknown share) / tokens of each ending's unit; unknown: log10 of that share over the
    share of all spellings that the ending has."""

    core: np.ndarray
    of: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    whole: np.ndarray
    rest: np.ndarray
    unknown: np.ndarray
    types: int
    tokens: int


def _units(core: np.ndarray, h: np.ndarray, shape: np.ndarray) -> np.ndarray:
    k = np.searchsorted(core, h)
    k[k == len(core)] = 0
    own = core[k] == h if len(core) else np.zeros(len(h), bool)
    return np.where(h == END, UNITS - 1, np.where(own, k, CORE + shape))


def exchange(n: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit, by moving one unit at a time to its best class until none moves.

    n[u, v] counts v after u. The class bigram likelihood is the sum of f over class pairs
    minus the sums of f over both margins, with f(x) = x log x. Units start in classes by
    rank of frequency; ties go to the lower class, so the result is deterministic.
    """
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    n = n.astype(float)
    size = len(n)
    of = np.empty(size, np.int64)
    order = np.argsort(-(n.sum(0) + n.sum(1)), kind="stable")
    of[order] = np.arange(size) % classes
    onto = np.eye(classes)[of]
    g = onto.T @ n @ onto
    diag = np.arange(classes)
    for _ in range(sweeps):
        moved = False
        for u in order:
            here, own = of[u], n[u, u]
            row = np.bincount(of, n[u], classes)
            col = np.bincount(of, n[:, u], classes)
            row[here] -= own
            col[here] -= own
            g[here] -= row
            g[:, here] -= col
            g[here, here] -= own
            gain = (f(g + row) - f(g)).sum(1) + (f(g + col[:, None]) - f(g)).sum(0)
            d = g[diag, diag]
            gain += f(d + row + col + own) - f(d + row) - f(d + col) + f(d)
            left, right = g.sum(1), g.sum(0)
            gain -= f(left + row.sum() + own) - f(left) + f(right + col.sum() + own) - f(right)
            best = int(np.argmax(gain))
            if gain[best] <= gain[here] + 1e-9:
                best = here
            moved |= best != here
            of[u] = best
            g[best] += row
            g[:, best] += col
            g[best, best] += own
        if not moved:
            break
    return of


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(g: np.ndarray) -> float:
    """Of class bigram counts g[before, after], but for what no class changes."""
    g = g.astype(float)
    return float(_f(g).sum() - _f(g.sum(0)).sum() - _f(g.sum(1)).sum())


def moves(g: np.ndarray, here: np.ndarray, near: np.ndarray, chunk: int = 20_000) -> np.ndarray:
    """Best class of each word, the others kept where they are.

    near[w] counts the word's neighbours by slot, its own repetitions only in the last.
    Only classes that a word has beside it change a term of the likelihood, so the cost
    grows with the filled slots. A word stays unless another class is better.
    """
    g, near = g.astype(float), near.astype(float)
    row, col, own = near[:, :CLASSES], near[:, CLASSES:-1], near[:, -1]
    all_w = np.arange(len(near))
    gain = np.zeros((len(near), CLASSES))
    for table, mine, other in ((g.T, row, col), (g, col, row)):
        w, j = np.nonzero(mine)
        for at in range(0, len(w), chunk):
            a, b = w[at : at + chunk], j[at : at + chunk]
            k = np.arange(len(a))
            x = table[b].copy()
            x[k, here[a]] -= mine[a, b]
            same = np.flatnonzero(b == here[a])
            x[same] -= other[a[same]]
            x[same, here[a[same]]] -= own[a[same]]
            first = np.flatnonzero(np.diff(a, prepend=-1))
            gain[a[first]] += np.add.reduceat(_f(x + mine[a, b][:, None]) - _f(x), first)
    d = np.tile(np.diag(g), (len(near), 1))
    d[all_w, here] -= row[all_w, here] + col[all_w, here] + own
    gain += _f(d + row + col + own[:, None]) - _f(d + row) - _f(d + col) + _f(d)
    for side, mine in ((g.sum(1), row), (g.sum(0), col)):
        n = (mine.sum(1) + own)[:, None]
        x = np.tile(side, (len(near), 1))
        x[all_w, here] -= n[:, 0]
        gain -= _f(x + n) - _f(x)
    best = gain.argmax(1)
    return np.where(gain[all_w, best] > gain[all_w, here] + 1e-9, best, here)


@dataclass
class _Known:
    """What the buckets told a block, by its numbers: hashes of all its words, their training
    counts, endings, the classes of placed words (-1: none yet, or not placed), and log10 P of
    the spellings of words that may be unknown."""

    h: np.ndarray
    n: np.ndarray
    shape: np.ndarray
    c: np.ndarray
    spelled: np.ndarray

    @classmethod
    def of(cls, counts: list[np.ndarray]) -> _Known:
        """From the buckets' answers; rare words have no hash here, and need none."""
        size = max((int(x["id"].max()) + 1 for x in counts if len(x)), default=0)
        out = cls(np.zeros(size, np.uint64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, -1), np.zeros(size, np.float32))
        for x in counts:
            if x.dtype == _SPELLED:
                out.spelled[x["id"]] = x["p"]
            elif x.dtype == _RARE:
                out.n[x["id"]], out.shape[x["id"]] = x["shape"] // SHAPES, x["shape"] % SHAPES
            else:
                out.h[x["id"]], out.n[x["id"]], out.shape[x["id"]] = x["h"], x["n"], x["shape"]
        return out

    def classes(self, core: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, class) of each word."""
        u = _units(core, self.h, self.shape)
        return u, np.where(self.c >= 0, self.c, of[u])

    def placed(self, core: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, ends): the words that are placed by exchange, those of each bucket together."""
        unit = _units(core, self.h, self.shape)
        own = np.flatnonzero((self.n >= LEAST) & (unit >= CORE) & (unit < UNITS - 1))
        bucket = (self.h[own] % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return own[order], np.searchsorted(bucket[order], np.arange(n + 1))


def _told(read: DataFrame, answers: DataFrame, places: DataFrame | None, spelled: bool = False) -> DataFrame:
    """What the buckets told each block (kinds 0 and 1), followed by its texts (2); spellings
    only where they are asked for."""
    none = F.lit(None)

    def told(d: DataFrame, kind: int) -> DataFrame:
        return d.where("kind = 0").select("block", F.lit(kind).alias("kind"), F.col("key").cast("int").alias("bucket"), "data", none.cast("string").alias("doc_id"), none.cast("boolean").alias("learn"))

    kind = F.when(F.col("bucket") == -2, 0).otherwise(2).alias("kind")
    both = told(answers, 0).unionByName(read.where(F.col("bucket").isin([-2, -1] if spelled else [-1])).select("block", kind, "bucket", "data", "doc_id", "learn"))
    if places is not None:
        both = both.unionByName(told(places, 1))
    return both.repartition(partitions(read.sparkSession), "block").sortWithinPartitions("block", "kind")


def _by_block(batches: Iterator[pd.DataFrame], core: np.ndarray, n: int) -> Iterator[tuple[int, _Known, pd.DataFrame]]:
    """(block, what it was told, some of its texts)."""
    block = known = None
    for b in batches:
        for k, g in b.groupby("block", sort=True):
            if k != block:
                block, counts, classes, known = k, [], [], None
            told = g[g.kind == 0]
            counts += [_unpacked_spelling(x) if at == -2 else np.frombuffer(x, _RARE if at else _TOLD) for at, x in zip(told.bucket, told.data)]
            told = g[g.kind == 1]
            classes += [(at, np.frombuffer(x, np.int8)) for at, x in zip(told.bucket, told.data)]
            g = g[g.kind == 2]
            if not len(g):
                continue
            if known is None:
                known = _Known.of(counts)
                if classes:
                    own, ends = known.placed(core, n)
                    for at, c in classes:
                        known.c[own[ends[at] : ends[at + 1]]] = c
                counts, classes = [], []
            yield int(block), known, g


def _streams(g: pd.DataFrame, most: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, numbers, row of each from there) of the texts, some at a time."""
    sizes = np.fromiter(map(len, g.data), np.int64, len(g)) // 4
    at = 0
    while at < len(g):
        past = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), most)) + at)
        ids = np.concatenate([np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1) for x in g.data.iloc[at:past]]).astype(np.int64)
        yield at, ids, np.repeat(np.arange(past - at), sizes[at:past])
        at = past


def _seeds(read: DataFrame, answers: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core, class of each unit, count of each unit): all that is collected is bounded by
    CORE, SHAPES and UNITS squared. Endings stand for all words but the core's here."""
    top = answers.where("kind = 2").orderBy(F.desc("n"), "key").limit(CORE).select("key").collect()
    core = np.array([r.key for r in top], np.int64).view(np.uint64)
    core = np.sort(core[core != END])

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, block = np.zeros(UNITS * UNITS, np.int64), None
        for k, known, g in _by_block(batches, core, 1):
            if k != block:
                block, unit = k, _units(core, known.h, known.shape)
            for _, ids, _ in _streams(g[g.learn.to_numpy(bool)]):
                u = unit[ids]
                n += np.bincount(np.concatenate(([UNITS - 1], u[:-1])) * UNITS + u, minlength=UNITS * UNITS)
        k = np.flatnonzero(n)
        yield pd.DataFrame({"pair": k, "n": n[k]})

    seen = _told(read, answers, None).mapInPandas(pairs, "pair int, n long")
    got = seen.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(UNITS * UNITS)
    n[got.pair.to_numpy(np.int64)] = got.n.to_numpy(float)
    n = n.reshape(UNITS, UNITS)
    return core, exchange(n), n.sum(0)


def _packed(w: np.ndarray, s: np.ndarray, n: np.ndarray, words: int) -> bytes:
    """Slots and counts of the words 0, 1, ..: mostly two bytes for each filled slot."""
    many = np.flatnonzero(n > 254)
    big = np.empty(len(many), _MANY)
    big["at"], big["n"] = many, n[many]
    filled = np.bincount(w, minlength=words).astype(np.uint8)
    return filled.tobytes() + s.astype(np.uint8).tobytes() + np.minimum(n, 255).astype(np.uint8).tobytes() + big.tobytes()


def _unpacked(data: bytes, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(data, np.uint8)
    w = np.repeat(np.arange(words), a[:words])
    s, n = a[words : words + len(w)], a[words + len(w) : words + 2 * len(w)].astype(np.int64)
    big = np.frombuffer(data[words + 2 * len(w) :], _MANY)
    n[big["at"]] = big["n"]
    return w, s, n


def _neighbours(core: np.ndarray, of: np.ndarray, n: int, contexts: bool):
    """Class bigrams (bucket -1), and for each block and bucket the block's words that are
    to be placed and, of its training texts, their neighbours by class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g2 = np.zeros(CLASSES * CLASSES, np.int64)
        columns = ["block", "bucket", "key", "n", "words", "here", "data"]
        block, held, end = None, [], of[UNITS - 1]

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key = np.concatenate([x for x, _ in held] or [np.empty(0, np.int64)])
            u, inv = np.unique(key, return_inverse=True)
            return u, np.bincount(inv, np.concatenate([x for _, x in held] or [np.empty(0)]), len(u)).astype(np.int64)

        def send() -> Iterator[pd.DataFrame]:
            key, count = merged()
            w, s = key // SLOTS, key % SLOTS
            at = np.searchsorted(w, ends)
            rows = []
            for k in np.flatnonzero(np.diff(ends)):
                mine, x = own[ends[k] : ends[k + 1]], slice(at[k], at[k + 1])
                e = _packed(w[x] - ends[k], s[x], count[x], len(mine))
                rows.append((block, int(k), 0, 0, told.h[mine].tobytes(), cls[mine].astype(np.int8).tobytes(), e))
            yield pd.DataFrame(rows, columns=columns)

        for b, known, g in _by_block(batches, core, n):
            if b != block:
                if contexts and block is not None:
                    yield from send()
                block, held, told = b, [], known
                _, cls = known.classes(core, of)
                own, ends = known.placed(core, n)
                slot = np.full(len(known.h), -1)
                slot[own] = np.arange(len(own))
            for _, k, _ in _streams(g[g.learn.to_numpy(bool)]):
                c = cls[k]
                before = np.concatenate(([end], c[:-1]))
                g2 += np.bincount(before * CLASSES + c, minlength=CLASSES * CLASSES)
                if not contexts:
                    continue
                w = slot[k]
                again = np.concatenate((k[1:] == k[:-1], [False]))
                back = np.concatenate(([False], again[:-1]))
                after = np.concatenate((c[1:], [end]))
                here = np.flatnonzero(w >= 0)
                fore = here[~back[here]]
                key = np.concatenate((w[here] * SLOTS + np.where(again, 2 * CLASSES, after)[here], w[fore] * SLOTS + CLASSES + before[fore]))
                held.append(np.unique(key, return_counts=True))
                if sum(len(x) for x, _ in held) > 2_000_000:
                    held = [merged()]
        if contexts and block is not None:
            yield from send()
        k = np.flatnonzero(g2)
        yield pd.DataFrame({"block": -1, "bucket": -1, "key": k, "n": g2[k], "words": None, "here": None, "data": None})

    return run


def _move_bucket(g2: np.ndarray):
    """Places a bucket's words: classes for the blocks (kind 0), words in each class (1)."""

    def run(g: pd.DataFrame) -> pd.DataFrame:
        words_of = [np.frombuffer(x, np.uint64) for x in g.words]
        h, first, inv = np.unique(np.concatenate(words_of), return_index=True, return_inverse=True)
        here = np.concatenate([np.frombuffer(x, np.int8) for x in g.here])[first].astype(np.int64)
        near, at = np.zeros((len(h), SLOTS), np.int64), 0
        for w, x in zip(words_of, g.data):
            k, slot, count = _unpacked(x, len(w))
            near[inv[at : at + len(w)][k], slot] += count  # a block has a word and slot once
            at += len(w)
        place, at, rows = moves(g2, here, near), 0, []
        for block, w in zip(g.block, words_of):
            rows.append((0, int(block), int(g.bucket.iloc[0]), 0, place[inv[at : at + len(w)]].astype(np.int8).tobytes()))
            at += len(w)
        rows += [(1, 0, int(c), int(x), b"") for c, x in enumerate(np.bincount(place, minlength=CLASSES)) if x]
        return pd.DataFrame(rows, columns=["kind", "block", "key", "n", "data"])

    return run


def _bigrams(near: DataFrame) -> np.ndarray:
    g2 = np.zeros(CLASSES * CLASSES, np.int64)
    for r in near.where("bucket < 0").groupBy("key").agg(F.sum("n").alias("n")).collect():
        g2[r.key] = r.n
    return g2.reshape(CLASSES, CLASSES)


def place(read: DataFrame, answers: DataFrame, core: np.ndarray, of: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(classes of the placed words for each block, class bigrams), after some rounds.

    In a round all words move at once by the counts of the round before. The first round
    places them; what a later one moves is kept if the likelihood rose.
    """
    n = partitions(read.sparkSession)
    kept = places = None
    for k in range(rounds + 1):
        near = _told(read, answers, places).mapInPandas(_neighbours(core, of, n, k < rounds), "block int, bucket int, key int, n long, words binary, here binary, data binary")
        near = written(near)
        let_go(read.sparkSession)
        g2 = _bigrams(near)
        if k > 1 and likelihood(g2) <= likelihood(kept[1]):
            forget(near)
            break
        kept = places, g2
        if k < rounds:
            places = written(near.where("bucket >= 0").groupBy("bucket").applyInPandas(_move_bucket(g2), "kind int, block int, key long, n long, data binary"))
        forget(near)
        let_go(read.sparkSession)
    return kept


def train(read: DataFrame, answers: DataFrame, spelled: np.ndarray) -> tuple[Model, DataFrame]:
    """The model, and the classes of the placed words for each block."""
    stat = {(r.kind, r.key): r.n for r in answers.where("kind IN (1, 3, 4)").groupBy("kind", "key").agg(F.sum("n").alias("n")).collect()}
    types, tokens = stat.get((1, 0), 0), stat.get((1, 1), 0)
    core, of, unit = _seeds(read, answers)
    let_go(read.sparkSession)
    places, g2 = place(read, answers, core, of)
    used = np.concatenate((np.arange(CORE) < len(core), np.ones(SHAPES + 1, bool)))  # a small vocabulary fills no core
    members = np.bincount(of[used], minlength=CLASSES).astype(float)
    for r in places.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).collect():
        members[r.key] += r.n
    ending = np.array([stat.get((4, s), 0) for s in range(SHAPES)], float)
    unit[CORE : CORE + SHAPES] = ending
    size = g2.sum(0).astype(float)
    share = (size + 1) / (size.sum() + CLASSES)
    move = (g2 + CLASSES * share) / (g2.sum(1, keepdims=True) + CLASSES)
    whole = size + 0.5 * members
    emit = (unit + 0.5) / whole[of]
    once = np.array([stat.get((3, s), 0) for s in range(SHAPES)], float)
    unknown = np.where(ending > 0, (np.minimum(once, ending) + 1) / (ending + 2), 1.0)  # without a rare word all of it
    rest = np.log10(np.maximum(1 - unknown, 1e-300) / np.maximum(ending, 1))
    return Model(core, of, np.log10(move), np.log10(emit), np.log10(whole), rest, np.log10(unknown) - endings(spelled), int(types), int(tokens)), places


def _score(m: Model, g: pd.DataFrame, known: _Known, unit: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rows of n_tokens, n_known, base_score, score, known_score."""
    out = np.zeros((len(g), 5))
    for at, k, doc in _streams(g):
        u, cls, c = unit[k], place[k], known.n[k]
        own = (c >= LEAST) & (u >= CORE) & (u < UNITS - 1)
        p = m.move[np.concatenate(([m.of[UNITS - 1]], cls[:-1])), cls]
        p += np.where(own, np.log10(c + 0.5) - m.whole[cls], m.emit[u])
        s = np.flatnonzero((u >= CORE) & (u < UNITS - 1) & ~own)
        e, cs = u[s] - CORE, c[s]
        p[s] += np.where(cs > 0, m.rest[e] + np.log10(np.maximum(cs, 1)), m.unknown[e] + known.spelled[k[s]])
        base = np.log10((c + 1) / (m.tokens + m.types + 1))
        n = int(doc[-1]) + 1 if len(doc) else 0
        for j, x in enumerate((None, c > 0, base, p, np.where(c > 0, p, 0.0))):
            out[at : at + n, j] = np.bincount(doc, x, n)
    return out


def read_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(texts as numbers, what the buckets answer the blocks about their words, spelling)."""
    spark = docs.sparkSession
    n = partitions(spark)
    blocks = _block(docs, doc_id, text, n).repartition(n, "block")
    spelled = spelling(docs.where(F.coalesce(fold(F.col(doc_id), 7) != 2, F.lit(False))), text)
    shared = spark.sparkContext.broadcast(spelled)
    path = scratch(spark, "read")
    rows = blocks.mapInPandas(lambda batches: _read(n, shared.value)(batches), "block int, bucket int, doc_id string, learn boolean, data binary")
    rows.withColumn("asks", (F.col("bucket") >= 0).cast("int")).write.partitionBy("asks").parquet(path)
    of = lambda asks: spark.read.schema(rows.schema).parquet(f"{path}/asks={asks}") if asks in there else spark.createDataFrame([], rows.schema)
    there = {r.asks for r in spark.read.schema("asks int").parquet(path).select("asks").distinct().collect()}
    let_go(spark)
    answers = of(1).groupBy("bucket").applyInPandas(_count_bucket, "kind int, block int, key long, n long, data binary")
    answers = written(answers)
    remove(spark, f"{path}/asks=1")
    return of(0), answers, spelled


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram), score (log10 probability of the class model) and
    known_score (the part of score that known tokens have). base_score charges each unknown
    word as if there were but one, score charges its spelling, so that the two compare over
    known tokens only.

    A text is its words and one end. Null and empty texts are just an end; texts may be of
    any length. Rows with a null id are scored but teach nothing and aren't held out.
    Repeated rows are scored alike, and each teaches. With nothing to learn from, base_score
    is 0 and score is that of the smoothing alone; an empty table gives an empty one. Ties
    between classes go to the lower one. Other columns of docs, whatever their names, are
    not returned.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    with small_batches(spark):
        read, answers, spelled = read_texts(docs, doc_id, text)
        let_go(spark)
        model, places = train(read, answers, spelled)
    shared = spark.sparkContext.broadcast(model)
    let_go(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, block = shared.value, None
        for b, known, g in _by_block(batches, m.core, n):
            if b != block:
                block, (unit, place) = b, known.classes(m.core, m.of)
            rows = _score(m, g, known, unit, place)
            yield pd.DataFrame({"doc_id": g.doc_id.to_numpy(object), "n_tokens": rows[:, 0].astype(np.int64), "n_known": rows[:, 1].astype(np.int64), "base_score": rows[:, 2], "score": rows[:, 3], "known_score": rows[:, 4]})

    out = _told(read, answers, places, True).mapInPandas(run, "doc_id string, n_tokens long, n_known long, base_score double, score double, known_score double")
    out = out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
    held = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out")
    tokens = F.lit(model.tokens).cast("long").alias("train_tokens")
    return out.select("doc_id", held, "n_tokens", "n_known", tokens, "base_score", "score", "known_score")


def op7(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents").select("doc_id", "text"))
