"""Vectorised tokenising and hashing of whole batches of texts with numpy.

A batch of texts becomes one byte buffer. Words are runs of bytes outside a set of
separators. The hash of a word is a polynomial over its bytes, read off two prefix
sums, then mixed; all words of a batch are hashed without a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_TABLE = mix(np.arange(1, 257, dtype=U) * U(0x632BE59BD9B4E019))
_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) <= n:
        n += n // 8
        inverse = U(pow(int(_BASE), -1, 1 << 64))
        for k, base in ((0, _BASE), (1, inverse)):
            p = np.full(n + 1, base, U)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def separators(keep) -> np.ndarray:
    """Boolean table over bytes: True where a byte parts words. keep(b): b belongs to words."""
    return np.array([not keep(b) for b in range(256)])


BLANKS = separators(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Letters, digits and every byte of a character beyond ASCII.
ALNUM = separators(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass
class Batch:
    """Words of some texts (strings, UTF-8 bytes or None). start, end: byte offsets in buf; doc: index of the text."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    doc_at: np.ndarray
    sums: np.ndarray

    def hashes(self, start=None, end=None) -> np.ndarray:
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mix((self.sums[end] - self.sums[start]) * _powers(len(self.buf))[1][start])


def words(texts: list, seps: np.ndarray = BLANKS, lower: bool = True) -> Batch:
    raw = [t if isinstance(t, bytes) else t.encode() if t else b"" for t in texts]
    data = b"\n".join(raw) + b"\n" if raw else b""
    if lower:
        data = data.translate(_LOWER)
    buf = np.frombuffer(data, np.uint8)
    is_sep = np.concatenate(([True], seps[buf], [True]))
    edge = np.flatnonzero(is_sep[1:] != is_sep[:-1])
    start, end = edge[::2], edge[1::2]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    doc_at = np.concatenate(([0], np.cumsum(sizes + 1)))
    doc = np.searchsorted(doc_at, start, "right") - 1
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(_TABLE[buf] * _powers(len(buf))[0][: len(buf)], out=sums[1:])
    return Batch(buf, start, end, doc, doc_at, sums)


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every size hashes in a row."""
    power, inverse = _powers(len(h))
    sums = np.zeros(len(h) + 1, U)
    np.cumsum(h * power[: len(h)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * inverse[: len(h) - size + 1])


def pieces(texts: list, limit: int = 1_000_000) -> Iterator[tuple[int, list]]:
    """Runs of whole texts of about limit characters, with the index of the first."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield at, texts[at : i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def text_list(series) -> list:
    """A pandas column of strings as a list, nulls as None."""
    return [t if isinstance(t, str) else None for t in series]
