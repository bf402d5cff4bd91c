"""Sub-word encoding and decoding by a weighted finite-state transducer.

load() reads a model file; Transducer compiles three machines of it and composes them with
each input over the tropical semiring (weights add along a path, the least path wins):

- The normaliser: a trie whose arcs rewrite the longest match of the character map, then a
  machine of the states START, WORD and GAP that puts the blank mark before the text,
  writes blanks as U+2581 and, if the model asks for it, squeezes them.
- The pieces: a trie of states and arcs over characters; a final state gives out a piece at
  its weight. A character that no piece has takes an arc that gives out its bytes' pieces
  (or the unknown piece).
- The pairs: its state is the piece before. A unigram model has one state and additive
  weights (minus the scores). A merge model's pieces weigh nothing, and an arc from piece a
  to piece b weighs 0 if merging the joined text of both yields just them, else infinity.
  An encoding whose neighbouring pairs all hold is the one the merges produce: the first
  merge across a boundary would happen in the pair alone as well. Weights of pairs are
  worked out as they are met, from how each piece splits into the two that it was merged of.

One routine takes the shortest path through the composed machine for both kinds of model:
all arcs of many inputs are laid out as arrays, and positions are relaxed from left to
right for all inputs at once. Blanks only ever begin a piece (or a run of blanks), so a text
falls into chunks that are composed one by one; a bounded memory of chunks spares most of it.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .tokens import pieces, text_list

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
START, WORD, GAP = 0, 1, 2
#: Memories of a worker: chunks with their ids (as many of the time before), and, as a power
#: of 2, weights of pairs. What is forgotten is worked out again.
CHUNKS, PAIRS = 200_000, 20


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message: int, bytes or four raw bytes."""
    i = 0

    def varint() -> int:
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, data[i : i + n]
            i += n


def character_map(blob: bytes) -> dict[str, str]:
    """What a normaliser rewrites, read off its double-array trie: 4 bytes of size, the
    trie's units, and the outputs, each ended by a zero byte."""
    if not blob:
        return {}
    size = struct.unpack_from("<I", blob)[0]
    units, text = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size :]
    step = (units >> 10) << ((units & (1 << 9)) >> 6)
    label = units & ((1 << 31) | 0xFF)
    letters, out = np.arange(1, 256), {}
    todo = [(int(step[0]), b"")]
    while todo:
        base, key = todo.pop()
        at = base ^ letters
        at = at[at < len(units)]
        for child in at[label[at] == (base ^ at)].tolist():
            word, below = key + bytes([base ^ child]), child ^ int(step[child])
            if units[child] >> 8 & 1:
                begin = int(units[below]) & ((1 << 31) - 1)
                out[word.decode()] = text[begin : text.index(b"\0", begin)].decode()
            todo.append((below, word))
    return out


def load(path: str = MODEL) -> dict:
    """Pieces, scores and kinds of a model file, its kind and its normaliser's settings.

    The file's size is fixed by its vocabulary, so what is made of it may be broadcast.
    Models with user-defined pieces or with the blank mark behind words are refused.
    """
    return read_model(Path(path).read_bytes())


def read_model(data: bytes) -> dict:
    pieces: list[tuple[str, float, int]] = []
    spec = {"kind": UNIGRAM, "prefix": True, "squeeze": True, "maps": {}}
    for number, value in _fields(data):
        got = dict(_fields(value)) if number in (1, 2, 3) else {}
        if number == 1:
            pieces.append((got[1].decode(), struct.unpack("<f", got.get(2, bytes(4)))[0], got.get(3, NORMAL)))
        elif number == 2:
            spec["kind"] = got.get(3, UNIGRAM)
            if got.get(24):
                raise ValueError("blanks as suffixes aren't supported")
        elif number == 3:
            spec |= {"prefix": bool(got.get(3, 1)), "squeeze": bool(got.get(4, 1)), "maps": character_map(got.get(2, b""))}
    if any(t == USER for _, _, t in pieces):
        raise ValueError("user-defined pieces aren't supported")
    return spec | {"pieces": pieces}


class Normaliser:
    """arcs: (state, is a blank) -> (state, output, whether the character follows it)."""

    def __init__(self, spec: dict):
        first = BLANK if spec["prefix"] else ""
        if spec["squeeze"]:
            self.arcs = {
                (START, True): (START, "", False), (START, False): (WORD, first, True), (WORD, True): (GAP, "", False),
                (WORD, False): (WORD, "", True), (GAP, True): (GAP, "", False), (GAP, False): (WORD, BLANK, True),
            }
        else:
            self.arcs = {(START, True): (WORD, first + BLANK, False), (START, False): (WORD, first, True), (WORD, True): (WORD, BLANK, False), (WORD, False): (WORD, "", True)}
        self.copies = {k: self.arcs.get((k, False)) == (k, "", True) for k in (START, WORD, GAP)}
        self.trie: dict[tuple[int, str], int] = {}
        self.out: dict[int, str] = {}
        for key, value in spec["maps"].items():
            node = 0
            for c in key:
                node = self.trie.setdefault((node, c), len(self.trie) + 1)
            self.out[node] = value

    def rewritten(self, text: str) -> str:
        """The character map's longest matches, from left to right, by its outputs."""
        if not self.trie:
            return text
        parts, i = [], 0
        while i < len(text):
            node, j, end, value = 0, i, i + 1, text[i]
            while j < len(text) and (node := self.trie.get((node, text[j]), -1)) >= 0:
                j += 1
                if node in self.out:
                    end, value = j, self.out[node]
            parts.append(value)
            i = end
        return "".join(parts)

    def run(self, chunk: str, state: int) -> tuple[str, int]:
        """(output, state) of a chunk read from a state; every state is final.

        Where the arc of characters but blanks copies them and stays, a run is copied whole.
        """
        out, i, n = [], 0, len(chunk)
        while i < n:
            c = chunk[i]
            state, before, own = self.arcs[state, c == " "]
            out.append(before + c if own else before)
            i += 1
            if i < n and self.copies[state]:
                end = chunk.find(" ", i)
                out.append(chunk[i:] if end < 0 else chunk[i:end])
                i = n if end < 0 else end
        return "".join(out), state


class _Halves(dict):
    """The two pieces whose merge makes a piece; None if merging doesn't yield it."""

    def __init__(self, order: dict[str, int]):
        super().__init__()
        self.order = order

    def __missing__(self, piece: str) -> tuple[str, str] | None:
        s = list(piece)
        while len(s) > 2:
            best, at = math.inf, -1
            for i in range(len(s) - 1):
                k = self.order.get(s[i] + s[i + 1], math.inf)
                if k < best:
                    best, at = k, i
            if at < 0:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        self[piece] = (s[0], s[1]) if len(s) == 2 else None
        return self[piece]


class Pairs:
    """The pair machine of a merge model. A pair is (piece before * many + piece); whether it
    holds is worked out when first met and kept in a table with one place for each hash."""

    def __init__(self, names: list[str | None], score: list[float]):
        self.names, self.many = names, len(names) + 1
        self.keys, self.good = np.full(1 << PAIRS, -1), np.zeros(1 << PAIRS, bool)
        # merges by order: of a better score first; equal scores aren't ordered
        rank = {x: i for i, x in enumerate(sorted({score[k] for k, p in enumerate(names) if p}, reverse=True))}
        self.order = {p: rank[score[k]] for k, p in enumerate(names) if p}
        self.halves = _Halves(self.order)

    def merged(self, text: str) -> list[str]:
        """Merge neighbours of the best score, leftmost first, until none is a piece."""
        s = list(text)
        while len(s) > 1:
            best, at = math.inf, -1
            for i in range(len(s) - 1):
                k = self.order.get(s[i] + s[i + 1], math.inf)
                if k < best:
                    best, at = k, i
            if at < 0:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        return s

    def holds(self, a: str, b: str) -> bool:
        """Whether merging a + b yields a and b.

        Going back in time from a and b, the later of the two merges is undone; at no time
        may the pieces that touch have a merge that was due before the merge undone last.
        """
        order, halves, due = self.order, self.halves, math.inf
        if a and a + b in order or len(b) > 1 and halves[b] is None:
            return False
        if not a:
            return True
        if BLANK + BLANK in a + b:  # runs of blanks have equal scores
            return self.merged(a + b) == [a, b]
        while True:
            if order.get(a + b, math.inf) < due:
                return False
            # of equal merges the left one is first, so the right one is undone first
            if len(a) > 1 and (len(b) == 1 or order[a] > order[b]):
                due, a = order[a], halves[a][1]
            elif len(b) > 1:
                due, b = order[b] + 0.5, halves[b][0]
            else:
                return True

    def _worked_out(self, pair: int) -> bool:
        a, b = divmod(pair, self.many)
        names = self.names
        # no piece has the character of a byte arc, so it merges with none
        return b >= len(names) or self.holds((names[a] or "") if a < len(names) else "", names[b])

    def hold(self, pair: np.ndarray) -> np.ndarray:
        """Whether each of some pairs holds."""
        slot = (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIRS)
        out, new = self.good[slot], np.flatnonzero(self.keys[slot] != pair)
        if len(new):
            u, at = np.unique(pair[new], return_inverse=True)
            out[new] = np.fromiter(map(self._worked_out, u.tolist()), bool, len(u))[at]
            self.keys[slot[new]], self.good[slot[new]] = pair[new], out[new]
        return out


class Transducer:
    """The machines of load()'s result, compiled; composed with texts by encode()."""

    def __init__(self, spec: dict):
        vocabulary = spec["pieces"]
        self.prefix = spec["prefix"]
        self.normaliser = Normaliser(spec)
        names = [p if t == NORMAL else None for p, _, t in vocabulary]
        self.byte = {int(p[3:5], 16): k for k, (p, _, t) in enumerate(vocabulary) if t == BYTE}
        self.is_byte = np.array([t == BYTE for _, _, t in vocabulary] or [False])
        self.unknown = next((k for k, (_, _, t) in enumerate(vocabulary) if t == UNKNOWN), 0)
        self.text = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t in (CONTROL, UNKNOWN) else p.encode() for p, _, t in vocabulary]
        self.other = len(vocabulary)  # stands for the arc of a character that no piece has
        self.pairs = Pairs(names, [s for _, s, _ in vocabulary]) if spec["kind"] == MERGES else None
        worst = min((s for _, s, k in vocabulary if k == NORMAL), default=0.0) - 10.0
        self.weight = np.array([0.0 if self.pairs is not None else -s for _, s, _ in vocabulary] + [0.0 if self.pairs is not None else -worst])
        self._compile([(p, k) for k, p in enumerate(names) if p])
        whole = any(BLANK in p.lstrip(BLANK) for p in names if p)
        line = "\n" if not any("\n" in p for p in names if p) else ""
        some = f"[ {BLANK}]*\n|" if line else ""
        self.chunk = re.compile("(?s).+" if whole else f"{some}[ {BLANK}]+[^ {BLANK}{line}]*|[^ {BLANK}{line}]+")
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _compile(self, named: list[tuple[str, int]]) -> None:
        """States and arcs of the pieces: symbol of a code point (0: none), the state after a
        first symbol, and other arcs as sorted (state, symbol) with the states they lead to."""
        letters = sorted({c for p, _ in named for c in p})
        self.symbol = np.zeros(0x110000, np.int32)
        self.symbol[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.symbols = len(letters) + 1
        of = {c: i + 1 for i, c in enumerate(letters)}
        arcs: dict[int, int] = {}
        final = {}
        for p, k in named:
            node = 0
            for c in p:
                node = arcs.setdefault(node * self.symbols + of[c], len(arcs) + 1)
            final[node] = k
        key = np.array(sorted(arcs), np.int64)
        self.arc = np.append(key, np.iinfo(np.int64).max)
        self.to = np.array([arcs[k] for k in key.tolist()] + [-1], np.int32)
        self.final = np.full(len(arcs) + 1, -1, np.int32)
        self.final[list(final)] = list(final.values())
        self.first = np.full(self.symbols, -1, np.int32)
        root = key[key < self.symbols]
        self.first[root] = [arcs[k] for k in root.tolist()]
        if self.pairs is not None and any(c not in self.pairs.order for c in letters):
            raise ValueError("a merge model needs a piece for every character of its pieces")

    def _lattice(self, sym: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Arcs (start, length, piece) of the composition with the pieces' machine."""
        at, depth = np.flatnonzero(self.first[sym] >= 0), 1
        node = self.first[sym[at]]
        start, size, piece = [], [], []
        alone = np.ones(len(sym), bool)
        while len(at):
            k = self.final[node]
            hit = k >= 0
            start.append(at[hit])
            size.append(np.full(int(hit.sum()), depth))
            piece.append(k[hit])
            if depth == 1:
                alone[at[hit]] = False
            depth += 1
            more = left[at] >= depth
            at, node = at[more], node[more]
            want = node.astype(np.int64) * self.symbols + sym[at + depth - 1]
            k = np.searchsorted(self.arc, want)
            ok = self.arc[k] == want
            at, node = at[ok], self.to[k[ok]]
        at = np.flatnonzero(alone)
        start.append(at)
        size.append(np.ones(len(at), np.int64))
        piece.append(np.full(len(at), self.other))
        return np.concatenate(start), np.concatenate(size), np.concatenate(piece)

    def shortest(self, texts: list[str]) -> list[bytes]:
        """Ids, as little-endian int32, of the least path of each normalised text; of equal
        paths the one whose last piece is longer."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sym = self.symbol[code]
        begin = np.concatenate(([0], np.cumsum(size)))[:-1]
        text = np.repeat(np.arange(len(texts)), size)
        at = np.arange(len(code)) - begin[text]
        start, length, piece = self._lattice(sym, size[text] - at)
        order = np.argsort(at[start], kind="stable")
        start, length, piece = start[order], length[order], piece[order].astype(np.int64)
        u = start + text[start]  # each text has one state more than characters
        v = u + length
        steps = np.searchsorted(at[start], np.arange(int(size.max(initial=0)) + 1))
        cost = np.full(len(code) + len(texts), np.inf)
        back = np.full(len(cost), -1)
        before = np.full(len(cost), self.other + 1)
        first = begin + np.arange(len(texts))
        cost[first] = 0.0
        for i, j in zip(steps[:-1].tolist(), steps[1:].tolist()):
            c = cost[u[i:j]] + self.weight[piece[i:j]]
            go = np.flatnonzero(c < cost[v[i:j]])
            if self.pairs is not None and len(go):
                go = go[self.pairs.hold(before[u[i + go]] * self.pairs.many + piece[i + go])]
            to = v[i + go]
            cost[to], back[to], before[to] = c[go], i + go, piece[i + go]
        state, k = first + size, np.arange(len(texts))
        far = np.isinf(cost[state])
        taken, of = [], []
        state, k = state[~far], k[~far]
        while True:
            more = state > first[k]
            state, k = state[more], k[more]
            if not len(k):
                break
            taken.append(back[state])
            of.append(k)
            state = u[taken[-1]]
        taken, of = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (taken, of))
        order = np.lexsort((start[taken], of))
        taken, of = taken[order], of[order]
        ids, ends = piece[taken].astype("<i4"), np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
        data = ids.tobytes()
        out = [data[4 * i : 4 * j] for i, j in zip(ends[:-1], ends[1:])]
        for t in np.unique(of[ids == self.other]).tolist():
            out[t] = self._bytes(texts[t], taken[ends[t] : ends[t + 1]], start - begin[text[start]], piece)
        for t in np.flatnonzero(far).tolist():  # pieces that no merges make: the merges themselves
            out[t] = self._ids([(p, self.pairs.names.index(p) if p in self.pairs.order else self.other) for p in self.pairs.merged(texts[t])])
        return out

    def _bytes(self, text: str, arcs: np.ndarray, at: np.ndarray, piece: np.ndarray) -> bytes:
        return self._ids([(text[at[a]], int(piece[a])) for a in arcs.tolist()])

    def _ids(self, path: list[tuple[str, int]]) -> bytes:
        """Outputs of a path: pieces, and the bytes of characters that no piece has."""
        ids: list[int] = []
        for c, k in path:
            if k != self.other:
                ids.append(k)
            elif self.byte:
                ids += [self.byte[b] for b in c.encode()]
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return struct.pack(f"<{len(ids)}i", *ids)

    def _compose(self, chunks: Iterable[tuple[str, int]]) -> Iterator[bytes]:
        """Ids of chunks read from a state, some 100,000 characters at a time."""
        held, size = [], 0
        for chunk, state in chunks:
            held.append(self.normaliser.run(chunk, state)[0])
            size += len(held[-1])
            if size > 100_000:
                yield from self.shortest(held)
                held, size = [], 0
        if held:
            yield from self.shortest(held)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none."""
        parts = [self.chunk.findall(self.normaliser.rewritten(t or "")) for t in texts]
        heads = self._compose((p[0], START) for p in parts if p)
        if len(self.memory) > CHUNKS:
            self.memory, self.older = {}, self.memory
        new = {c for p in parts for c in p[1:]} - self.memory.keys()
        again = new & self.older.keys()
        self.memory.update({c: self.older[c] for c in again})
        new = list(new - again)
        self.memory.update(zip(new, self._compose(zip(new, repeat(WORD)))))
        get = self.memory.__getitem__
        out = [np.frombuffer(b"".join([next(heads), *map(get, p[1:])]) if p else b"", "<i4") for p in parts]
        for c in new:
            if len(c) > 64:
                del self.memory[c]
        return out

    def decode(self, ids) -> str:
        """Text of ids: pieces and bytes joined, U+2581 as a blank, the leading one removed."""
        text = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _workers(spark, path: str):
    """A function that gives each Python worker its own transducer."""
    shared = spark.sparkContext.broadcast(load(path))
    held: list[Transducer] = []

    def get() -> Transducer:
        if not held:
            held.append(Transducer(shared.value))
        return held[0]

    return get


def encode(docs: DataFrame, text: str = "text", out: str = "ids", path: str = MODEL) -> DataFrame:
    """docs with an array of ids; [] for null and empty texts.

    Whole texts are encoded, however long. Every row is encoded by itself, so repeated rows
    have equal ids. A column of the input called as out is replaced; others stay.
    """
    get = _workers(docs.sparkSession, path)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = get()
        for s in batches:
            for at, part in pieces(text_list(s)):
                s.iloc[at : at + len(part)] = t.encode(part)
            yield s

    return docs.withColumn(out, F.pandas_udf(run, "array<int>").asNondeterministic()(F.col(text)))


def decode(docs: DataFrame, ids: str = "ids", out: str = "text", path: str = MODEL) -> DataFrame:
    """docs with the text of ids; '' for null and []. A column called as out is replaced."""
    get = _workers(docs.sparkSession, path)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = get()
        for s in batches:
            yield pd.Series([t.decode(x if x is not None else ()) for x in s], index=s.index)

    return docs.withColumn(out, F.pandas_udf(run, "string").asNondeterministic()(F.col(ids)))


_DIGEST = "n_tokens long, n_bytes long, ids_crc32 long, round_trip boolean"


def digest(docs: DataFrame, text: str = "text", out: str = "encoded", path: str = MODEL) -> DataFrame:
    """docs with a struct about the whole text's encoding: number of ids and of byte ids,
    crc32 of the ids as little-endian int32, and whether decoding them gives the text back.

    Null and empty texts have no ids, and come back as the empty text. U+2581 in a text
    stands for a blank in this family of models and comes back as one, so such a text
    makes no round trip. Repeated rows have equal digests; an empty table gives an empty
    one. A column of the input called as out is replaced; others stay.
    """
    import zlib

    get = _workers(docs.sparkSession, path)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = get()
        for s in batches:
            rows = []
            for _, part in pieces(text_list(s)):
                for x, ids in zip(part, t.encode(part)):
                    rows.append((len(ids), int(t.is_byte[ids].sum()), zlib.crc32(ids.tobytes()), t.decode(ids.tolist()) == (x or "")))
            yield pd.DataFrame(rows, columns=["n_tokens", "n_bytes", "ids_crc32", "round_trip"])

    return docs.withColumn(out, F.pandas_udf(run, _DIGEST).asNondeterministic()(F.col(text)))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(docs).select("doc_id", "encoded.*")
