"""Line dedup: an exact set-similarity join by prefix, positional and length filters.

A line is the set of its words (A-Z lower-cased). Words are ordered by rarity, counted
over all documents in a table of fixed size; ties go by hash, so the order is the same
everywhere. Two lines of Jaccard t or more share a word within their prefixes, the first
|x| - ceil(t |x|) + 1 words; they meet there and are tested by length, by position and by
a bitmap that bounds their overlap from above. What passes is verified exactly. Last, a
line is removed where an earlier line, by (doc_id, line number), is similar to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import hot_join, let_go, partitions, small_batches, table, unused, written
from .sets import LARGE, Spans, bounds, buckets, key_filter, large_components, links_by_prefix, passes, runs, verified
from .tokens import BLANKS, pieces, text_list, words

THRESHOLD = 0.8
RARITY_BITS = 18
_RECORD = np.dtype([("tok", "<u8"), ("line", "<u8"), ("size", "<i4"), ("pos", "<i4"), ("b0", "<u8"), ("b1", "<u8")])


def _key(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line, seed=42)


def rarity(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(ranks, words): ranks of the words' hash buckets by occurrences over all documents, a
    table of 2 MB, and how many occurrences there are.

    Words are ordered by the rank of their bucket, then by the low bits of their hash.
    """
    size = 1 << RARITY_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(size, np.int64)
        for b in batches:
            for _, part in pieces(text_list(b.iloc[:, 0])):
                h = words(part, BLANKS).hashes()
                n += np.bincount((h >> np.uint64(64 - RARITY_BITS)).astype(np.int64), minlength=size)
        yield pd.DataFrame([(k, x.tobytes()) for k, x in enumerate(n.reshape(64, -1)) if x.any()], columns=["chunk", "data"])

    def total(g: pd.DataFrame) -> pd.DataFrame:
        n = np.sum([np.frombuffer(x, np.int64) for x in g.data], axis=0)
        return pd.DataFrame({"chunk": g.chunk[:1], "data": [n.tobytes()]})

    schema = "chunk int, data binary"
    out = np.zeros((64, size // 64), np.int64)
    for r in docs.select(text).mapInPandas(count, schema).groupBy("chunk").applyInPandas(total, schema).collect():
        out[r.chunk] = np.frombuffer(r.data, np.int64)
    rank = np.empty(size, np.uint64)
    rank[np.argsort(out.reshape(-1), kind="stable")] = np.arange(size, dtype=np.uint64)
    return rank, int(out.sum())


def _line_sets(texts: list, rank: np.ndarray | None, wanted=None):
    """(keys, line, h) of the distinct lines: h sorted by line and rarity, distinct in a line.

    line indexes keys. Lines without words have no set. wanted: picks keys, as a mask.
    """
    raw = b"\n".join(t.encode() for t in texts if t).split(b"\n")
    keys, first = np.unique(np.fromiter(map(_key, raw), np.uint64, len(raw)), return_index=True)
    if wanted is not None:
        pick = wanted(keys)
        keys, first = keys[pick], first[pick]
    b = words([raw[k] for k in first.tolist()], BLANKS)
    at, h = b.doc.astype(np.uint64), b.hashes()
    order = None
    if len(keys) < 1 << 20:  # one key to sort by: line, rank of the word's bucket, some of its hash
        by = np.uint64(0) if rank is None else rank[h >> np.uint64(64 - RARITY_BITS)]
        one = at << np.uint64(44) | by << np.uint64(26) | (h & np.uint64((1 << 26) - 1))
        order = np.argsort(one)
        x, y = one[order], h[order]
        if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():
            order = None
    if order is None:
        order = np.lexsort((h, at) if rank is None else (h, h & np.uint64((1 << 26) - 1), rank[h >> np.uint64(64 - RARITY_BITS)], at))
    at, h = b.doc[order], h[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (at[1:] != at[:-1])))
        at, h = at[new], h[new]
        used = np.bincount(at, minlength=len(keys)) > 0
        at, keys = (np.cumsum(used) - 1)[at], keys[used]
    else:
        keys = keys[:0]
    return keys, at, h


def _least(n: np.ndarray, t: float) -> np.ndarray:
    return np.ceil(n * t - 1e-9).astype(np.int64)


def prefix_records(texts: list, rank: np.ndarray, t: float) -> np.ndarray:
    keys, at, h = _line_sets(texts, rank)
    if not len(h):
        return np.empty(0, _RECORD)
    size = np.bincount(at, minlength=len(keys))
    begin = np.concatenate(([0], np.cumsum(size)[:-1]))
    bit = np.uint64(1) << ((h >> np.uint64(3)) & np.uint64(63))
    high = (h >> np.uint64(9)) & np.uint64(1) > 0
    b0 = np.bitwise_xor.reduceat(np.where(high, np.uint64(0), bit), begin)
    b1 = np.bitwise_xor.reduceat(np.where(high, bit, np.uint64(0)), begin)
    pos = np.arange(len(h)) - begin[at]
    k = np.flatnonzero(pos < (size - _least(size, t) + 1)[at])
    out = np.empty(len(k), _RECORD)
    a = at[k]
    out["tok"], out["line"], out["size"], out["pos"], out["b0"], out["b1"] = h[k], keys[a], size[a], pos[k], b0[a], b1[a]
    return out


def candidates(r: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of lines to the least line that passing pairs join them to."""
    r = r[np.lexsort((r["line"], r["size"], r["tok"]))]
    if not len(r):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    r = r[np.concatenate(([True], (r["tok"][1:] != r["tok"][:-1]) | (r["line"][1:] != r["line"][:-1])))]
    tok, size, pos, b0, b1 = (r[x] for x in ("tok", "size", "pos", "b0", "b1"))
    size, pos = size.astype(np.int64), pos.astype(np.int64)
    spans, i, d = Spans(len(r)), np.arange(len(r)), 0
    j = i + 1
    while True:
        d += 1
        go = j < len(r)
        i, j = i[go], j[go]
        if d & (d - 1) == 0 and d > 1 and len(i):  # rows that a row is joined with are passed over, up to the next one that it isn't
            root = spans.roots()
            last = np.flatnonzero(np.append((tok[1:] != tok[:-1]) | (root[1:] != root[:-1]), True))
            j = np.where((tok[i] == tok[j]) & (root[i] == root[j]), last[np.searchsorted(last, j)] + 1, j)
            go = j < len(r)
            i, j = i[go], j[go]
        go = (tok[i] == tok[j]) & (size[i] >= _least(size[j], t))  # sizes rise within a word
        i, j = i[go], j[go]
        if not len(i):
            break
        need = _least((size[i] + size[j]) / (1 + t), t)
        ok = 1 + np.minimum(size[i] - pos[i] - 1, size[j] - pos[j] - 1) >= need
        x, y = i[ok], j[ok]
        apart = np.bitwise_count(b0[x] ^ b0[y]).astype(np.int64) + np.bitwise_count(b1[x] ^ b1[y])
        ok = (size[x] + size[y] - apart) // 2 >= need[ok]
        spans.add(x[ok], y[ok])
        j = j + 1
    line, root = r["line"].astype(np.uint64).view(np.int64), spans.roots()
    least = line.copy()
    np.minimum.at(least, root, line)
    least = least[root]
    k = np.flatnonzero(least != line)
    return least[k], line[k]


def _meet(docs: DataFrame, text: str, rank: np.ndarray, n_words: int, t: float) -> DataFrame:
    n = buckets(docs.sparkSession, n_words * 0.35 * _RECORD.itemsize)  # about so many records a word
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    def deal(parts: list[np.ndarray]) -> pd.DataFrame:
        r = np.concatenate(parts)
        bucket = (r["tok"] % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(n + 1))
        return pd.DataFrame([(k, r[order[ends[k] : ends[k + 1]]].tobytes()) for k in range(n) if ends[k] < ends[k + 1]], columns=["bucket", "data"])

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for b in batches:
            for _, part in pieces(text_list(b.iloc[:, 0])):
                held.append(prefix_records(part, shared.value, t))
            if sum(map(len, held)) > 500_000:
                yield deal(held)
                held = []
        if held:
            yield deal(held)

    def join(g: pd.DataFrame) -> pd.DataFrame:
        a, b = candidates(np.concatenate([np.frombuffer(x, _RECORD) for x in g.data]), t)
        return pd.DataFrame({"src": a, "dst": b}).drop_duplicates()

    records = docs.select(text).mapInPandas(prefixes, "bucket int, data binary")
    return records.groupBy("bucket").applyInPandas(join, "src long, dst long")


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, doc_id, rk, ln) of every line with a word; rk tells apart rows of one doc_id."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("rk"), F.posexplode(F.split(text, "\n")).alias("ln", "line"))
    return d.where(F.col("line").rlike(r"[^\x20\x09-\x0D]")).select(F.xxhash64("line").alias("key"), "doc_id", "rk", "ln")


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", t: float = THRESHOLD, large: int = LARGE) -> DataFrame:
    """(doc_id, rk, removed): numbers, from 0, of the lines to remove, for rows that have any.

    rk is xxhash64 of the text. Lines are ordered by (doc_id, rk, number), null ids first;
    a line is removed if any earlier line, kept or not, is the same or similar. Lines
    without a word and null texts have nothing to remove. Repeated rows (same id and text)
    are one document, so they don't remove each other's lines. Texts may be of any length,
    ids of any type that has an order.
    """
    with small_batches(docs.sparkSession):  # all that needs Python is done when this returns
        return _removed(docs, doc_id, text, t, large)


def _removed(docs: DataFrame, doc_id: str, text: str, t: float, large: int) -> DataFrame:
    spark = docs.sparkSession
    rank, n_words = rarity(docs, text)
    links = written(_meet(docs, text, rank, n_words, t))
    let_go(spark)
    comp = written(connected_components(links).select(F.col("node").alias("key"), "component"))
    shared = spark.sparkContext.broadcast(key_filter(comp.select("key")))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            for _, part in pieces(text_list(b.iloc[:, 0])):
                keys, at, h = _line_sets(part, None, lambda k: passes(shared.value, k.view(np.int64)))
                ends = np.searchsorted(at, np.arange(len(keys) + 1))
                rows = [(k, h[ends[i] : ends[i + 1]].tobytes()) for i, k in enumerate(keys.view(np.int64).tolist()) if k not in seen]
                seen.update(k for k, _ in rows)
                if len(seen) > 500_000:
                    seen.clear()
                yield pd.DataFrame(rows, columns=["key", "words"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, "component"):
            sets, later = [np.frombuffer(x, np.uint64) for x in g.words], np.zeros(len(g), bool)
            ends = bounds(g.component.to_numpy())
            for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                for lead, others in verified(sets[i:j], t):
                    later[i + lead] |= others.min(initial=lead) < lead
                    later[i + others[others > lead]] = True
            yield pd.DataFrame({"key": g.key[later]})

    occ = written(occurrences(docs, doc_id, text))
    first = occ.groupBy("key").agg(F.min(F.struct("doc_id", "rk", "ln")).alias("f"), F.count("*").alias("n"))
    sets = docs.select(text).mapInPandas(fetch, "key long, words binary").join(comp, "key")
    sets = sets.groupBy("key").agg(F.first("words").alias("words"), F.first("component").alias("component"))
    met = sets.join(first, "key").select("key", "words", "component", "f")
    some = large_components(comp, large)
    apart = not some.isEmpty()
    near = met.join(some, "component", "left_anti") if apart else met
    near = near.repartition(partitions(spark), "component").sortWithinPartitions("component", "f").drop("f")
    later = near.mapInPandas(verify, "key long")
    if apart:
        ranks = spark.sparkContext.broadcast(rank)
        far = met.join(some, "component", "left_semi").withColumnRenamed("words", "data").withColumnRenamed("f", "o")
        of = links_by_prefix(far, t, np.uint64, lambda h: ranks.value[h >> np.uint64(64 - RARITY_BITS)], chain=False)
        later = later.unionAll(of.select(F.col("dst").alias("key")).distinct())
    known = first.join(later.withColumn("all", F.lit(True)), "key", "left").where("n > 1 OR all").select("key", "f", "n", F.coalesce("all", F.lit(False)).alias("all"))
    gone = hot_join(occ, written(known), "key", "n", occ.count()).where(F.col("all") | ~F.struct("doc_id", "rk", "ln").eqNullSafe(F.col("f")))
    return gone.groupBy("doc_id", "rk").agg(F.sort_array(F.collect_set("ln")).alias("removed"))


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", t: float = THRESHOLD, out: str = "removed_lines") -> DataFrame:
    """docs with an array of the numbers of the lines to remove ([] where there are none).

    See removed_lines() for nulls, ties and repeated rows; an empty table stays one. A column
    of the input called as out is replaced; others stay.
    """
    i, k, r = unused(docs, "gone_id"), unused(docs, "gone_rk"), unused(docs, "gone")
    gone = removed_lines(docs, doc_id, text, t).select(F.col("doc_id").alias(i), F.col("rk").alias(k), F.col("removed").alias(r))
    met = docs.join(gone, F.col(doc_id).eqNullSafe(F.col(i)) & (F.xxhash64(text) == F.col(k)), "left")
    return met.withColumn(out, F.coalesce(r, F.array().cast("array<int>"))).drop(i, k, r)


def without_lines(docs: DataFrame, removed: str = "removed_lines", text: str = "text") -> DataFrame:
    """docs whose text lacks the lines of the array; a text that loses none, null and empty
    ones too, stays as it is. Lines are counted from 0; a text that loses all is empty."""
    lines = F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(removed, i))
    return docs.withColumn(text, F.when(F.size(removed) > 0, F.array_join(lines, "\n")).otherwise(F.col(text)))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.coalesce(F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0))
    gone = removed_lines(docs).select(F.col("doc_id").alias("id"), F.col("rk").alias("gone_rk"), "removed")
    of = docs.select("doc_id", F.xxhash64("text").alias("rk"), lines.cast("long").alias("n_lines"))
    met = of.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("rk") == F.col("gone_rk")), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    numbers = F.array_join(F.transform(removed, lambda x: x.cast("string")), ",")
    return met.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), numbers.alias("removed_lines"))


#: The same join in SQL; lines of one doc_id must be of one text.
OP9_SQL = r"""
WITH o AS (
  SELECT doc_id, unnest(range(0, len(l))) AS ln, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)
), w AS (
  SELECT doc_id, ln, list_sort(list_distinct(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS s
  FROM o WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), c AS (
  SELECT s, len(s) AS n, row_number() OVER (ORDER BY min(doc_id * 1000000 + ln)) AS id, min(doc_id * 1000000 + ln) AS f FROM w GROUP BY s
), t AS (SELECT id, n, unnest(s) AS tok FROM c
), q AS (SELECT tok, count(*) AS df FROM t GROUP BY tok
), p AS (
  SELECT id, n, tok FROM (SELECT id, n, tok, row_number() OVER (PARTITION BY id ORDER BY df, tok) AS pos FROM t JOIN q USING (tok)) WHERE pos <= n - (4 * n + 4) // 5 + 1
), m AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.tok = b.tok AND a.id < b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), v AS (
  SELECT DISTINCT b FROM (SELECT m.b, x.n + y.n AS n, len(list_intersect(x.s, y.s)) AS k FROM m JOIN c x ON x.id = m.a JOIN c y ON y.id = m.b) WHERE 5 * k >= 4 * (n - k)
), r AS (
  SELECT doc_id, ln FROM w JOIN c USING (s) LEFT JOIN v ON v.b = c.id WHERE v.b IS NOT NULL OR doc_id * 1000000 + ln > f
), g AS (SELECT doc_id, count(*) AS n, string_agg(ln::VARCHAR, ',' ORDER BY ln) AS l FROM r GROUP BY doc_id
), k AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n, 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_removed, coalesce(g.l, '') AS removed_lines
FROM documents d LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""
