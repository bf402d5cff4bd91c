"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark text.

Texts are normalised to words parted by single blanks and scanned once; hits are mapped
back to words and to code-point offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, unused, written
from .tokens import _LOWER

WINDOW = 10
#: Windows an automaton holds at most; a larger benchmark is scanned for in blocks, each
#: against all texts, so what is broadcast at once stays bounded.
BLOCK = 500_000
#: Upper case belongs to words here, as this runs over the text before lower-casing.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in _LOWER)
_HIT = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>, words array<struct<first:int,past:int>>"


def normalise(text: str | None) -> str:
    """Words, a blank on either side of each; UTF-8 bytes as Latin-1 characters."""
    w = (text or "").encode().translate(_WORDS).split()
    return (b" " + b" ".join(w) + b" ").decode("latin-1") if w else ""


def windows(text: str | None, size: int = WINDOW) -> set[str]:
    w = normalise(text).split(" ")[1:-1]
    return {f" {' '.join(w[i : i + size])} " for i in range(max(1, len(w) - size + 1))} if w else set()


def _automaton(found: dict[str, set[str]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("\x00", (0, 1, []))  # no text has it; an automaton of nothing can't be searched
    for win, items in found.items():
        a.add_word(win, (win.count(" ") - 1, len(win), sorted(items)))
    a.make_automaton()
    return a


def _scan(text: str | None, automaton, before: tuple[list, list] = ([], [])) -> tuple[int, int, list, list]:
    """n_words, n_hit, items and hit runs of words (first, past), those before included."""
    norm = normalise(text)
    if not norm:
        return 0, 0, [], []
    n = norm.count(" ") - 1
    items, marks, blanks = set(before[0]), None, None
    for end, (k, length, names) in automaton.iter(norm):
        if marks is None:
            marks = np.zeros(n + 1, np.int64)
            blanks = np.flatnonzero(np.frombuffer(norm.encode("latin-1"), np.uint8) == 32)
        i = int(np.searchsorted(blanks, end - length + 1))
        marks[i] += 1
        marks[i + k] -= 1
        items.update(names)
    if marks is None and not before[1]:
        return n, 0, [], []
    marks = np.zeros(n + 1, np.int64) if marks is None else marks
    for first, past in before[1]:
        marks[first] += 1
        marks[past] -= 1
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(marks) > 0).astype(np.int8)))))
    runs = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
    return n, sum(b - a for a, b in runs), sorted(items), runs


def _row(text: str | None, found: tuple[int, int, list, list]) -> tuple:
    n, hit, items, runs = found
    at = [m.span() for m in WORD.finditer(text)] if runs else []
    spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in runs]
    return n, hit, items, spans, [{"first": a, "past": b} for a, b in runs]


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW, block: int = BLOCK) -> Iterator[dict[str, set[str]]]:
    """The windows of all items with their item ids, in blocks of at most about block windows.

    The benchmark is read through an iterator and one block is held at a time. Items without
    a word or without an id have no windows; an id on several rows has the windows of all.
    """
    held: dict[str, set[str]] = {}
    for row in benchmark.select(F.col(item_id).cast("string"), text).toLocalIterator():
        for win in windows(row[1], size) if row[0] is not None else ():
            if len(held) >= block and win not in held:
                yield held
                held = {}
            held.setdefault(win, set()).add(row[0])
    if held:
        yield held


def _pass(docs: DataFrame, block: dict[str, set[str]], text: str, out: str, again: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    built: list = []

    def rows(s: pd.Series, old) -> pd.DataFrame:
        if not built:
            built.append(_automaton(shared.value))
        before = (([*i], [(w["first"], w["past"]) for w in r]) for i, r in zip(old["items"], old["words"])) if old is not None else (([], []) for _ in s)
        return pd.DataFrame([_row(t, _scan(t, built[0], b)) for t, b in zip(s, before)], columns=["n_words", "n_hit", "items", "spans", "words"])

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield rows(s, None)

    def scan_again(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        for s, old in batches:
            yield rows(s, old)

    f = F.pandas_udf(scan_again if again else scan, _HIT).asNondeterministic()
    return docs.withColumn(out, f(F.col(text), F.col(out)) if again else f(F.col(text)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, out: str = "leak", block: int = BLOCK) -> DataFrame:
    """docs with a struct column: n_words, n_hit (words inside an occurrence of a window),
    items (ids of items with an occurring window, sorted), spans (code points of the
    original, end exclusive, one for each run of hit words) and words (the runs by number).

    Null, empty and wordless texts have 0, 0 and empty arrays. Without benchmark items
    nothing is hit. Texts may be of any length; windows that overlap or occur in several
    items count once a word. Repeated rows have equal results; a column of the input called
    as out is replaced, others stay. A benchmark of more than block windows is scanned for
    in as many passes, and the rows are written between them.
    """
    blocks = benchmark_windows(benchmark, text="text", size=size, block=block)
    docs = _pass(docs, next(blocks, {}), text, out, False)
    for b in blocks:
        docs = _pass(written(docs), b, text, out, True)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of docs without a hit word, with their columns. Null, empty and wordless texts stay."""
    leak = unused(docs, "leak")
    return find_leaks(docs, benchmark, text, out=leak).where(F.col(leak)["n_hit"] == 0).drop(leak)


def op5(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "leak.n_words", "leak.n_hit", "leak.items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def items_sha256(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
  SELECT DISTINCT item, len(w[i:i + 9]) AS k, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM bw
), dw AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= k)
), h AS (SELECT r, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win
), n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r
), it AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""
