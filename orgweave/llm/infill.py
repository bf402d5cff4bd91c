"""Fill-in-middle transformation: one byte automaton finds lines, characters and sentinels.

The automaton's states say how many continuation bytes a UTF-8 character still lacks, whether
a unit has begun, and how much of a sentinel has been read. Each transition counts: a
character, the end of a unit, a sentinel. What a state remembers are the last few bytes, so
a batch of texts is cut into lanes that are read abreast, each from a few bytes before its
start. A second pass looks the cuts up among the ends of units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: No UTF-8 text has this byte; it stands behind every text of a batch.
END = 0xFF
#: What transitions count, as bits; the number of a sentinel, from 1, stands above them.
CHAR, UNIT, MARK = 1, 2, 4
LANES, STEPS = 8192, 256
_NEWLINE = 0x0A
#: Bytes of texts that are scanned at once.
BATCH = 2_000_000


class Scanner:
    """The automaton of some sentinels, compiled to a table by state and byte."""

    def __init__(self, sentinels: tuple[str, ...]):
        raw = [s.encode() for s in sentinels]
        for a in raw:
            for b in raw:
                if not a or b"\n" in a or (a is not b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError("sentinels must be on one line, and none may overlap another")
        self.sizes = [len(s) for s in raw]
        self.memory = max(4, *self.sizes)
        heads = sorted({s[:k] for s in raw for k in range(len(s) + 1)}, key=len)
        states = {(b"", 0, False): 0}
        table, counts = [], []
        for state in (todo := [(b"", 0, False)]):
            read, lacks, begun = state
            row, count = [], []
            for b in range(256):
                if b == END:
                    to, n = (b"", 0, False), UNIT if begun else 0
                else:
                    inside = 0x80 <= b < 0xC0 and lacks > 0
                    tail = read + bytes([b])
                    head = next(h for h in reversed(heads) if tail.endswith(h))
                    lacks_now = lacks - 1 if inside else (0 if b < 0xC0 else 1 if b < 0xE0 else 2 if b < 0xF0 else 3)
                    to = (head, lacks_now, b != _NEWLINE)
                    n = (0 if inside else CHAR) | (UNIT if b == _NEWLINE else 0) | (MARK * (raw.index(head) + 1) if head in raw else 0)
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                row.append(states[to] << 8)
                count.append(n)
            table.append(row)
            counts.append(count)
        if len(states) > 256 or len(raw) > 60:
            raise ValueError("the sentinels are too long for a table of 256 states")
        self.next = np.array(table, np.uint16).reshape(-1)
        self.counts = np.array(counts, np.uint8).reshape(-1)

    def scan(self, buf: np.ndarray) -> np.ndarray:
        """What the transition of each byte counts."""
        n = len(buf)
        lanes = max(1, min(LANES, n // max(STEPS, self.memory)))
        steps = -(-n // lanes)
        padded = np.full(steps * lanes, END, np.uint8)
        padded[:n] = buf
        abreast = np.ascontiguousarray(padded.reshape(lanes, steps).T)
        state = np.zeros(lanes, np.uint16)
        for k in range(self.memory, 0, -1) if lanes > 1 else ():
            state[1:] = self.next[state[1:] | padded[steps - k : -steps : steps]]
        at = np.empty((steps, lanes), np.uint16)
        for i in range(steps):
            np.bitwise_or(state, abreast[i], out=at[i])
            np.take(self.next, at[i], out=state, mode="clip")
        return self.counts[at.T.reshape(-1)[:n]]


class Scanned:
    """A batch of texts (UTF-8 bytes) and what the automaton counted in them."""

    def __init__(self, raw: list[bytes], scanner: Scanner):
        end = bytes([END])
        self.data = end.join(raw) + end if raw else b""
        buf = np.frombuffer(self.data, np.uint8)
        self.at = np.concatenate(([0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)))
        counted = scanner.scan(buf) if raw else np.empty(0, np.uint8)
        ends = np.flatnonzero(counted & UNIT)
        self.first = np.searchsorted(ends, self.at)
        self.ends = ends + (buf[ends] == _NEWLINE)
        self.chars = np.concatenate(([0], np.cumsum(counted & CHAR, dtype=np.int32 if len(buf) < 1 << 31 else np.int64)))
        marks = np.flatnonzero(counted >= MARK)
        self.mark, self.mark_end = counted[marks] // MARK, marks + 1
        self.first_mark = np.searchsorted(marks, self.at)

    @property
    def units(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def marked(self) -> np.ndarray:
        return np.diff(self.first_mark) > 0

    def cut(self, unit: np.ndarray) -> np.ndarray:
        """Offsets behind so many units of each text."""
        ends = np.append(self.ends, 0)
        return np.where(unit > 0, ends[self.first[:-1] + unit - 1], self.at[:-1])


def transformed(raw: list[bytes], low: np.ndarray, high: np.ndarray, wanted: list[str], scanner: Scanner, names: tuple[bytes, bytes, bytes]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of texts; low, high: numbers whose
    remainders by n + 1 are the cuts; chars are -1 where the form is plain."""
    s = Scanned(raw, scanner)
    n = s.units
    one, two = low % (n + 1), high % (n + 1)
    a, b = s.cut(np.minimum(one, two)), s.cut(np.maximum(one, two))
    plain = (n == 0) | s.marked | (np.array(wanted, object) == "plain")
    prefix_chars = np.where(plain, -1, s.chars[a] - s.chars[s.at[:-1]])
    middle_chars = np.where(plain, -1, s.chars[b] - s.chars[a])
    p, q, m = names
    form, out = [], []
    for t, is_plain, w, at, i, j in zip(raw, plain.tolist(), wanted, s.at.tolist(), a.tolist(), b.tolist()):
        form.append("plain" if is_plain else w)
        i, j = i - at, j - at
        if is_plain:
            out.append(t)
        elif w == "spm":
            out.append(b"".join((q, t[j:], p, t[:i], m, t[i:j])))
        else:
            out.append(b"".join((p, t[:i], q, t[j:], m, t[i:j])))
    return n, form, prefix_chars, middle_chars, out


def rebuilt(raw: list[bytes], form: list[str | None], scanner: Scanner) -> list[bytes]:
    """Texts that outputs of a form were made from."""
    s, out = Scanned(raw, scanner), []
    for k, (t, f) in enumerate(zip(raw, form)):
        if f not in ("psm", "spm"):
            out.append(t)
            continue
        i, at = int(s.first_mark[k]), int(s.at[k])
        kinds = [int(x) for x in s.mark[i : i + 3]]
        if kinds != ([1, 2, 3] if f == "psm" else [2, 1, 3]) or s.first_mark[k + 1] - i != 3 or s.mark_end[i] - at != scanner.sizes[kinds[0] - 1]:
            raise ValueError(f"no output of the form {f}")
        x, y, z = (int(e) - at for e in s.mark_end[i : i + 3])
        first, second, middle = t[x : y - scanner.sizes[kinds[1] - 1]], t[y : z - scanner.sizes[2]], t[z:]
        out.append(b"".join((first, middle, second) if f == "psm" else (second, middle, first)))
    return out


def _runs(texts: pa.Array) -> Iterator[slice]:
    """Neighbouring texts of about BATCH bytes; a batch without texts is one run."""
    at, held = 0, 0
    size = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for k, n in enumerate(size):
        held += n
        if held >= BATCH:
            yield slice(at, k + 1)
            at, held = k + 1, 0
    if at < len(size) or not size:
        yield slice(at, len(size))


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.to_pylist()]


_MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", out: str = "infill", seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """docs with a struct: n (lines), form (plain, psm or spm), prefix_chars, middle_chars (code
    points, null where plain) and output.

    Cuts and form follow from the hash of seed and doc_id alone: rate of 100 texts are
    transformed, spm of 100 of them with the suffix first. An empty text, and one that has a
    sentinel, stays plain. Null texts count as empty, a null id as an empty one. Texts of any
    length are read whole; repeated rows have equal results, an empty table gives an empty
    one. A column of the input called as out is replaced, others stay.
    """
    scanner, names = Scanner(sentinels), tuple(s.encode() for s in sentinels)
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(h, 8 * k - 7, 8), 16, 10).cast("long")
    wanted = F.when(number(3) % 100 >= rate, "plain").when(number(4) % 100 < spm, "spm").otherwise("psm")

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, h1, h2, w in batches:
            low, high, forms = h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False), w.to_pylist()
            for k in _runs(texts):
                n, form, a, b, made = transformed(_bytes(texts[k]), low[k], high[k], forms[k], scanner, names)
                yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64(), mask=a < 0), pa.array(b, pa.int64(), mask=b < 0), pa.array(made, pa.binary()).cast(pa.string())], ["n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.withColumn(out, F.arrow_udf(run, _MADE).asNondeterministic()(F.col(text).cast("binary"), number(1), number(2), wanted))


def restore(docs: DataFrame, output: str | Column = "output", form: str | Column = "form", out: str = "restored", sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """docs with the text that output was made from; null where output is.

    Any form but psm and spm is plain. An output that isn't of its form is an error. A column
    of the input called as out is replaced, others stay.
    """
    scanner = Scanner(sentinels)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for made, forms in batches:
            f = pc.if_else(made.is_null(), "plain", forms)
            for k in _runs(made):
                whole = pa.array(rebuilt(_bytes(made[k]), f[k].to_pylist(), scanner), pa.binary()).cast(pa.string())
                yield pc.if_else(made[k].is_null(), pa.scalar(None, pa.string()), whole)

    column = lambda c: F.col(c) if isinstance(c, str) else c
    return docs.withColumn(out, F.arrow_udf(run, "string").asNondeterministic()(column(output).cast("binary"), column(form)))


def op12(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = transform(docs).select("doc_id", "infill.*")
    return restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
), c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
