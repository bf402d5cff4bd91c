"""Substring dedup by MinHash banding of paragraphs.

A paragraph is a line. A line of more than one sentence also gives its longer sentences,
so that a passage set into another paragraph is found. Each is the set of its five-word
shingles (fewer words: the whole). 27 minima in 9 bands of 3 find a pair of Jaccard 0.8
with probability 0.998. Paragraphs that collide in a band are joined, verified by exact
Jaccard, and clustered by connected components; of each cluster the first occurrence
stays and the others are removed, where neighbouring ones together make a passage.

With sure_words, passages that begin and end anywhere are met by windows: with 50, of every 26 windows of 25 words in
a row the one with the least hash is a unit of one band, its key. So any 50 words that two
documents have in common, inside sentences or over the ends of lines, give both the same one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import forget, hot_join, let_go, partitions, place, remove, small_batches, table, written
from .sets import LARGE, bounds, buckets, key_filter, large_components, linked, links_by_prefix, passes, runs
from .tokens import BLANKS, Batch, mix, pieces, rolling, text_list, words

_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """sentence_words: words a sentence needs to be a unit of its own. passage_words: words
    that a shared unit, or neighbouring shared units together, need to count as a passage; a
    window has as many. sure_words: as many equal words in a row that several documents have
    are found wherever they begin; 0: no windows."""

    threshold: float = 0.8
    shingle: int = 5
    bands: int = 9
    rows: int = 3
    sentence_words: int = 12
    passage_words: int = 25
    sure_words: int = 0


_BAND = np.dtype([("band", "<u8"), ("key", "<u8")])
#: As sent to a bucket: the bucket and half of a band's hash tell bands apart well enough,
#: since what collides by chance is verified like the rest.
_SENT = np.dtype([("band", "<u4"), ("key", "<u8")])
_STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?"])


#: Of passages that repeat across documents.
ACROSS = Settings(sure_words=50)


@dataclass
class Units:
    """Units of some texts, in order: text, number of the line, its number among the text's
    lines that have words, sentence number (-1: the line itself), first and one past the last
    word of the batch, key."""

    doc: np.ndarray
    line: np.ndarray
    nth: np.ndarray
    part: np.ndarray
    first: np.ndarray
    past: np.ndarray
    key: np.ndarray


def units(texts: list, s: Settings):
    """(batch of words, Units). The key of a unit is the XXH64 of its words, A-Z lower-cased.

    A sentence that makes nine tenths of its line is no unit beside it.
    """
    b = words(texts, BLANKS)
    ends = np.flatnonzero(b.buf == 10)
    line = np.searchsorted(ends, b.start)
    if not len(line):
        z = np.empty(0, np.int64)
        return b, Units(z, z, z, z, z, z, z.view(np.uint64))
    new = np.flatnonzero(np.diff(line, prepend=-1))
    past = np.append(new[1:], len(line))
    stop = _STOPS[b.buf[b.end - 1]]
    fresh = np.diff(line, prepend=-1) != 0
    begin = np.flatnonzero(fresh | np.concatenate(([True], stop[:-1])))
    upto = np.append(begin[1:], len(line))
    whole = np.searchsorted(new, begin, "right") - 1
    nth = np.arange(len(begin)) - np.searchsorted(begin, new)[whole]
    n, line_n = upto - begin - s.shingle + 1, (past - new)[whole] - s.shingle + 1
    long = (upto - begin >= s.sentence_words) & (n < 0.9 * line_n)
    first = np.concatenate((new, begin[long]))
    past = np.concatenate((past, upto[long]))
    part = np.concatenate((np.full(len(new), -1), nth[long]))
    order = np.lexsort((part, line[first]))
    first, past, part = first[order], past[order], part[order]
    doc = b.doc[first]
    whole = b.buf.tobytes()
    spans = zip(b.start[first].tolist(), b.end[past - 1].tolist())
    key = np.fromiter((xxhash.xxh64_intdigest(b" ".join(whole[i:j].split()), seed=42) for i, j in spans), np.uint64, len(first))
    start_line = np.searchsorted(ends, b.doc_at[:-1])
    row = np.searchsorted(new, first, "right") - 1  # its line among the batch's lines that have words
    return b, Units(doc, line[first] - start_line[doc], row - np.searchsorted(b.doc[new], doc), part, first, past, key)


def shingles(h: np.ndarray, first: np.ndarray, past: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, begin): shingles of each unit's words, and where each unit's begin. Fewer
    words than a shingle's make one shingle of them all."""
    n = np.maximum(past - first - size + 1, 1)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], n) + np.repeat(first, n)
    last = np.repeat(past, n)
    out = np.zeros(len(at), _U)
    for k in range(size):
        inside = at + k < last
        out = np.where(inside, mix(out + h[np.minimum(at + k, len(h) - 1)] + _U(k + 1)), out)
    return out, begin


def windows(b: Batch, h: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(first word, key) of the windows that the texts of a batch give: of sure_words words in a
    row at least one of passage_words, picked by what it says, once for each text."""
    picked = s.sure_words - s.passage_words + 1
    if picked < 1 or len(h) < s.sure_words:
        return np.empty(0, np.int64), np.empty(0, _U)
    key = rolling(h, s.passage_words)
    mask = _U((1 << len(key).bit_length()) - 1)
    least, span = (key & ~mask) | np.arange(len(key), dtype=_U), 1  # a window's hash, then its place
    while 2 * span <= picked:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    least = np.minimum(least[: len(least) - picked + span], least[picked - span :])
    at = (least[b.doc[: len(least)] == b.doc[s.sure_words - 1 :]] & mask).astype(np.int64)
    at = at[np.diff(at, prepend=-1) != 0]
    order = np.lexsort((at, key[at], b.doc[at]))
    k, d = key[at][order], b.doc[at][order]
    at = np.sort(at[order[np.concatenate(([True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])))[: len(at)]]])
    return at, key[at]


def _distinct(u: Units) -> Units:
    _, k = np.unique(u.key, return_index=True)
    return Units(*(x[k] for x in (u.doc, u.line, u.nth, u.part, u.first, u.past, u.key)))


def band_records(texts: list, s: Settings) -> np.ndarray:
    """Records of the distinct units; a unit that the texts have more than once has one more, a
    window that several of them have as well.

    Units of so few shingles that similar ones must be equal have one band, of their key.
    The lowest bit of a band's hash tells the first band, which every unit has.
    """
    b, u = units(texts, s)
    if not len(u.key):
        return np.empty(0, _BAND)
    _, k, often = np.unique(u.key, return_index=True, return_counts=True)
    u = Units(*(x[k] for x in (u.doc, u.line, u.nth, u.part, u.first, u.past, u.key)))
    least = int(np.floor(s.threshold / (1 - s.threshold) + 1e-9)) if s.threshold < 1 else 1 << 30
    long = np.flatnonzero(u.past - u.first - s.shingle + 1 >= least)  # one less shingle is least / (least + 1)
    h = b.hashes()
    sh, begin = shingles(h, u.first[long], u.past[long], s.shingle)
    rng = np.random.default_rng(7)
    a = rng.integers(1, 1 << 63, s.bands * s.rows, dtype=np.uint64) | _U(1)
    c = rng.integers(0, 1 << 63, s.bands * s.rows, dtype=np.uint64)
    first = np.empty(len(u.key), _BAND)
    first["band"], first["key"] = mix(u.key), u.key
    out = np.empty((s.bands - 1, len(long)), _BAND)
    for band in range(s.bands if len(long) else 0):
        key = np.full(len(long), band + 1, _U)
        for r in range(s.rows):
            k = band * s.rows + r
            key = mix(key + np.minimum.reduceat(sh * a[k] + c[k], begin[:-1]))
        if band:
            out[band - 1]["band"], out[band - 1]["key"] = key & ~_U(1 << 32), u.key[long]
        else:
            first["band"][long] = key
    first["band"] |= _U(1 << 32)
    k, several = np.unique(windows(b, h, s)[1], return_counts=True)
    window = np.empty(len(k), _BAND)
    window["band"], window["key"] = mix(k) | _U(1 << 32), k
    return np.concatenate((first, out.reshape(-1), first[often > 1], window, window[several > 1]))


def _collide(docs: DataFrame, text: str, s: Settings) -> DataFrame:
    """Links (src, dst) that join the units of each band's bucket, and (key, key) for units that
    occur more than once. Buckets are as many as the texts' size asks for."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = buckets(docs.sparkSession, size * 1.2)  # records of a text take about as much as it does

    def deal(parts: list[np.ndarray]) -> pd.DataFrame:
        r = np.concatenate(parts)
        bucket = ((r["band"] & _U(0xFFFFFFFF)) % _U(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(n + 1))
        sent = np.empty(len(r), _SENT)
        sent["band"], sent["key"] = r["band"] >> _U(32), r["key"]
        r = sent
        return pd.DataFrame([(k, r[order[ends[k] : ends[k + 1]]].tobytes()) for k in range(n) if ends[k] < ends[k + 1]], columns=["bucket", "data"])

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for b in batches:
            for _, part in pieces(text_list(b.iloc[:, 0]), PIECE):
                held.append(band_records(part, s))
            if sum(map(len, held)) > 400_000:
                yield deal(held)
                held = []
        if held:
            yield deal(held)

    def join(g: pd.DataFrame) -> pd.DataFrame:
        r = np.concatenate([np.frombuffer(x, _SENT) for x in g.data])
        band, key = r["band"].copy(), r["key"].copy().view(np.int64)
        order = np.lexsort((key, band))
        band, key = band[order], key[order]
        at = bounds(band)
        least = np.repeat(key[at[:-1]], np.diff(at))
        again = np.flatnonzero((key[1:] == key[:-1]) & (band[1:] == band[:-1]) & (band[1:] & 1 > 0))
        i = np.flatnonzero(least != key)
        return pd.DataFrame({"src": np.concatenate((least[i], key[again])), "dst": np.concatenate((key[i], key[again]))}).drop_duplicates()

    records = docs.select(text).mapInPandas(bands, "bucket int, data binary")
    return records.groupBy("bucket").applyInPandas(join, "src long, dst long")


#: Characters that a worker reads at once; a longer text is read as one.
PIECE = 300_000
#: Bytes of a shingle's hash as it is sent. Two sets of 100 shingles have a false one in
#: common once in 10**10 pairs.
WIDTH = 6


def narrow(h: np.ndarray) -> bytes:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def wide(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // WIDTH, 8), np.uint8)
    out[:, :WIDTH] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    return out.view("<u8").reshape(-1)


_FOUND = "kind int, key long, id string, rk long, line int, nth int, part int, n int, sh binary"


def _found(docs: DataFrame, doc_id: str | None, text: str, s: Settings, sets: DataFrame, occurrences: DataFrame | None) -> str:
    """Where one more reading of the texts is written: shingles (kind 1) of the units that have
    their key in sets, now and then one more, and the places (kind 0) of those in occurrences.
    A window's part is -2 less the number of its first word."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast(key_filter(sets))
    placed = spark.sparkContext.broadcast(key_filter(occurrences) if occurrences is not None else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for b in batches:
            for at, part in pieces(text_list(b.t), PIECE):
                w, u = units(part, s)
                h, key = w.hashes(), u.key.view(np.int64)
                if placed.value is not None:
                    k = np.flatnonzero(passes(placed.value, key))
                    g = b.iloc[at : at + len(part)]
                    yield pd.DataFrame({"kind": 0, "key": key[k], "id": g.id.to_numpy(object)[u.doc[k]], "rk": g.rk.to_numpy()[u.doc[k]], "line": u.line[k], "nth": u.nth[k], "part": u.part[k], "n": (u.past - u.first)[k], "sh": None})
                    first, found = windows(w, h, s)
                    k = np.flatnonzero(passes(placed.value, found.view(np.int64)))
                    of, nth = w.doc[first[k]], first[k] - np.searchsorted(w.doc, w.doc[first[k]])
                    yield pd.DataFrame({"kind": 0, "key": found.view(np.int64)[k], "id": g.id.to_numpy(object)[of], "rk": g.rk.to_numpy()[of], "line": 0, "nth": 0, "part": -2 - nth, "n": s.passage_words, "sh": None})
                u = _distinct(u)
                key = u.key.view(np.int64)
                k = np.flatnonzero(passes(wanted.value, key))
                k = k[[x not in seen for x in key[k].tolist()]] if len(k) else k
                if not len(k):
                    continue
                sh, begin = shingles(h, u.first[k], u.past[k], s.shingle)
                seen.update(key[k].tolist())
                if len(seen) > 100_000:
                    seen.clear()
                of = np.repeat(np.arange(len(k)), np.diff(begin))
                order = np.lexsort((sh, of))
                sh, of = sh[order], of[order]
                new = np.concatenate(([True], (sh[1:] != sh[:-1]) | (of[1:] != of[:-1])))
                ends = (WIDTH * np.searchsorted(of[new], np.arange(len(k) + 1))).tolist()
                whole = narrow(sh[new])
                data = [whole[i:j] for i, j in zip(ends[:-1], ends[1:])]
                yield pd.DataFrame({"kind": 1, "key": key[k], "id": None, "rk": 0, "line": 0, "nth": 0, "part": 0, "n": 0, "sh": data})

    name = F.col(doc_id).cast("string") if doc_id else F.lit(None).cast("string")
    rows = docs.select(name.alias("id"), F.xxhash64(text).alias("rk"), F.col(text).alias("t")).mapInPandas(run, _FOUND)
    path = place(spark, "found")
    rows.write.partitionBy("kind").parquet(path)
    spark.createDataFrame([(0,), (1,)], "kind int").coalesce(1).withColumn("key", F.lit(None).cast("long")).write.mode("append").partitionBy("kind").parquet(path)  # both are there
    return path


def widened(sh):
    """A column of sets with their hashes' bytes filled up to eight."""
    
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: wide(x).tobytes())

    return F.pandas_udf(run, "binary")(sh)


def _of_kind(spark, found: str, kind: int) -> DataFrame:
    schema = ", ".join(c for c in _FOUND.split(", ") if not c.startswith("kind"))
    return spark.read.schema(schema).parquet(f"{found}/kind={kind}").where("key IS NOT NULL")


def _verified(found: str, comp: DataFrame, s: Settings, large: int) -> DataFrame:
    """(key, cluster) of the units whose exact Jaccard links them to others."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in runs(batches, "component"):
            sets, key = [wide(x) for x in g.sh], g.key.to_numpy()
            ends, root = bounds(g.component.to_numpy()), np.empty(len(g), np.int64)
            for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                root[i:j] = i + linked(sets[i:j], s.threshold)
            many = np.bincount(root, minlength=len(g))[root] > 1
            yield pd.DataFrame({"key": key[many], "cluster": key[root[many]]})

    sets = _of_kind(comp.sparkSession, found, 1).select("key", "sh").join(comp, "key")
    sets = sets.groupBy("key").agg(F.first("sh").alias("sh"), F.first("component").alias("component"))
    some = large_components(comp, large)
    apart = not some.isEmpty()
    near = sets.join(some, "component", "left_anti").select("key", "sh", "component") if apart else sets
    near = near.repartition(partitions(comp.sparkSession), "component").sortWithinPartitions("component", "key")
    out = near.mapInPandas(verify, "key long, cluster long")
    if apart:
        far = sets.join(some, "component", "left_semi").select("component", "key", widened(F.col("sh")).alias("data"), F.col("key").alias("o"))
        links = links_by_prefix(far, s.threshold, np.uint64, lambda x: x, chain=True)
        out = out.unionAll(connected_components(links))
    return out


def _components(links: DataFrame) -> DataFrame:
    return written(connected_components(links.where("src <> dst")).select(F.col("node").alias("key"), "component"))


def clusters(docs: DataFrame, text: str = "text", s: Settings = Settings(), large: int = LARGE) -> DataFrame:
    """(key, cluster): verified clusters of different units; cluster is the least key.

    Units that collide in any band are candidates; each is linked to the least key it
    collides with, which joins the same components as all pairs would. Each candidate component is
    verified on the sets of its distinct units' shingles, as hashes of 48 bits.
    """
    comp = _components(written(_collide(docs, text, s)))
    return _verified(_found(docs, None, text, s, comp.select("key"), None), comp, s, large)


def shared_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings(), large: int = LARGE) -> DataFrame:
    """One row for each unit whose cluster has units of several lines: id, rk, line, nth (the
    line's number among those that have words), part (-1: the line, else the sentence's number), n (words), first_id (least id that has the unit's
    cluster), removed (an earlier occurrence exists) and across (its cluster has units of several
    documents). Sentences of a cluster's first
    line that are similar to it by others don't count.

    Occurrences are ordered by (id, rk, line, part), null ids first. rk is xxhash64 of the
    text: repeated rows (same id and text) are one document. Null, empty and wordless
    texts have no units. Word case of A-Z and blanks between words make no difference.
    Only units that occur more than once or collide with others are placed; they are
    summed by key and by cluster, and hot ones met by broadcast, so none is one task's.
    """
    return _shared(docs, doc_id, text, s, large).where("part >= -1").distinct()


def _shared(docs: DataFrame, doc_id: str, text: str, s: Settings, large: int) -> DataFrame:
    """shared_units(), and the windows that several documents have; repeated rows repeat theirs."""
    spark = docs.sparkSession
    with small_batches(spark):
        links = written(_collide(docs, text, s))
        let_go(spark)
        comp = _components(links)
        let_go(spark)
        found = _found(docs, doc_id, text, s, comp.select("key"), links.select(F.explode(F.array("src", "dst"))).distinct())
        of = written(_verified(found, comp, s, large))
    forget(links)
    remove(spark, f"{found}/kind=1")
    let_go(spark)
    kind = docs.schema[doc_id].dataType
    occ = _of_kind(spark, found, 0).select("key", F.col("id").cast(kind).alias("id"), "rk", "line", "nth", "part", "n")
    at, line = F.struct("id", "rk", "line", "part"), F.struct("id", "rk", "line")
    ends = (F.min(at).alias("f"), F.max(line).alias("l"), F.min("id").alias("first_id"))
    keys = written(occ.groupBy("key").agg(*ends, F.count("*").alias("places")).join(of, "key", "left").withColumn("c", F.coalesce("cluster", "key")).drop("cluster"))
    let_go(spark)
    by = keys.groupBy("c").agg(F.min("f").alias("f"), F.max("l").alias("l"), F.min("first_id").alias("first_id"), F.count("*").alias("n_keys"))
    first_line = F.struct(F.col("f.id").alias("id"), F.col("f.rk").alias("rk"), F.col("f.line").alias("line"))
    by = by.where(~first_line.eqNullSafe(F.col("l")))
    by = by.withColumn("across", ~(F.col("f.id").eqNullSafe(F.col("l.id")) & F.col("f.rk").eqNullSafe(F.col("l.rk"))))
    total = keys.agg(F.count("*"), F.coalesce(F.sum("places"), F.lit(0))).first()
    told = hot_join(keys.select("key", "c", "places"), by, "c", "n_keys", total[0]).select("key", "places", "f", "first_id", "across")
    met = hot_join(occ, told, "key", "places", total[1])
    met = met.where(~line.eqNullSafe(first_line) | at.eqNullSafe(F.col("f")) | (F.col("f.part") >= 0))
    return met.select("id", "rk", "line", "nth", "part", "n", "first_id", (~at.eqNullSafe(F.col("f"))).alias("removed"), "across")


def _passages(u, s: Settings):
    """Of some units of a text in order, those whose run has passage_words words or more. A run
    goes on with the next sentence of a line, or the next line that has words; a line that
    counts in whole doesn't count by sentence again."""
    none = F.filter(u, lambda x: F.lit(False))
    start = F.struct(F.lit(-9).alias("nth"), F.lit(-9).alias("part"), F.lit(0).alias("n"), none.alias("run"), none.alias("out"))

    def step(a, x):
        inside = (x["nth"] == a["nth"]) & (a["part"] == -1)
        near = inside | ((x["nth"] == a["nth"]) & (x["part"] - a["part"] <= 3)) | ((x["nth"] == a["nth"] + 1) & (x["part"] <= 0))
        n = F.when(near, a["n"]).otherwise(0) + F.when(inside, 0).otherwise(x["n"])
        run = F.concat(F.when(near, a["run"]).otherwise(none), F.array(x))
        enough = n >= s.passage_words  # the units of a run that is long enough wait no longer
        return F.struct(
            x["nth"].alias("nth"), F.when(inside, a["part"]).otherwise(x["part"]).alias("part"), n.alias("n"),
            F.when(enough, none).otherwise(run).alias("run"), F.when(enough, F.concat(a["out"], run)).otherwise(a["out"]).alias("out"),
        )

    return F.aggregate(u, start, step, lambda a: a["out"])


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", s: Settings = Settings(), large: int = LARGE) -> DataFrame:
    """One row per row of docs: doc_id, n_shared and n_removed (units of passages that have
    their like elsewhere, or earlier), removed_lines (numbers from 0), first_ids (the least
    doc_id of each cluster of a passage's units, distinct and sorted) and repeated: whether
    anything is removed.

    A passage is a run of neighbouring shared units, or removed ones for what is removed, of
    at least passage_words words together; shorter ones are left alone. Lines without words
    don't part neighbours. With sure_words, n_shared counts only units that have their like in
    another document, and where there are none, the windows that others have; n_removed and
    repeated go by windows, too, where no line or sentence is removed. Null, empty and wordless texts have zeros and empty arrays; so
    has everything in an empty table. Repeated rows have equal results; of equal texts under
    different ids the one with the least id comes first. Texts may be of any length, ids of
    any type that has an order; other columns of docs are not returned.
    """
    found = _shared(docs, doc_id, text, s, large)
    unit = F.struct("nth", "part", "n", "line", "first_id", "removed", "across")
    window = F.col("part") < -1
    rows = found.groupBy("id", "rk").agg(F.sort_array(F.collect_set(F.when(~window, unit))).alias("u"), F.collect_set(F.when(window, unit)).alias("w"))
    rows = rows.withColumn("gone", _passages(F.filter("u", lambda x: x["removed"]), s)).withColumn("u", _passages(F.col("u"), s))
    other = F.filter("u", lambda x: x["across"]) if s.sure_words else F.col("u")
    rows = rows.select("id", "rk", "u", F.when(F.size(other) > 0, other).otherwise(F.col("w")).alias("shared"), F.when(F.size("gone") > 0, F.col("gone")).otherwise(F.filter("w", lambda x: x["removed"])).alias("gone"))
    lines = F.sort_array(F.array_distinct(F.transform(F.filter("gone", lambda x: x["part"] == -1), lambda x: x["line"])))
    firsts = F.sort_array(F.array_distinct(F.filter(F.transform(F.concat("u", "shared"), lambda x: x["first_id"]), lambda v: v.isNotNull())))
    rows = rows.select("id", "rk", F.size("shared").cast("long").alias("n_shared"), F.size("gone").cast("long").alias("n_removed"), lines.alias("removed_lines"), firsts.alias("first_ids"), (F.size("gone") > 0).alias("repeated"))
    mine = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("k"))
    met = mine.join(rows, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("k") == F.col("rk")), "left")
    types = dict(rows.dtypes)
    empty = lambda c: F.coalesce(c, F.array().cast(types[c])).alias(c)
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return met.select("doc_id", n("n_shared"), n("n_removed"), empty("removed_lines"), empty("first_ids"), F.coalesce("repeated", F.lit(False)).alias("repeated"))


def op4(spark, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents").select("doc_id", "text"), s=ACROSS)
