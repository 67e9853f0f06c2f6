"""Vectorised words and hashes over Arrow string columns.

The operators see a batch of texts as one UTF-8 byte buffer plus row offsets,
so finding words and hashing word n-grams are a handful of array operations per
batch instead of a Python step per word.  Batches are cut into pieces of about
``PIECE_BYTES`` (a single longer text is one piece), which bounds memory by the
longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_U = np.uint64


def byte_class(separators: bytes) -> np.ndarray:
    """Lookup table: True for bytes that belong to words."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


#: words [^\x20\x09-\x0D]+
PLAIN_WORD = byte_class(b" \t\n\x0b\x0c\r")
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of A-Z lower-cased text
ALNUM_WORD = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: letters of A-Z lower-cased text; bytes of non-ASCII characters count as letters
LETTER_WORD = byte_class(bytes([*range(0x61), *range(0x7B, 0x80)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_Q = _U(0x9E3779B97F4A7C15)
_R = _U(0xD1342543DE82EF95)


def _inverse(q: int) -> int:
    return pow(q, -1, 1 << 64)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    key = int(base)
    have = _tables.get(key)
    if have is not None and len(have[0]) > n:
        return have
    size = max(n, PIECE_BYTES + 1024) + 1

    def run(x: int) -> np.ndarray:
        a = np.full(size, x, _U)
        a[0] = 1
        return np.multiply.accumulate(a)

    out = run(key), run(_inverse(key))
    if size <= 4 * PIECE_BYTES:
        _tables[key] = out
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; spreads polynomial sums over all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    if len(column) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` text bytes each."""
    n = batch.num_rows
    if not n:
        return
    _, off = buffers(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        to = min(n, max(at + 1, to))
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of a column: byte ranges ``start``/``end``, ``row`` of each word,
    and ``first`` (first word index of each row, one entry more than rows)."""

    def __init__(self, column: pa.Array, is_word: np.ndarray = PLAIN_WORD, lower: bool = False):
        self.raw, self.offsets = buffers(column)
        self.data = LOWER[self.raw] if lower else self.raw
        self.rows = len(self.offsets) - 1
        self.is_word = is_word
        m = is_word[self.data]
        if len(m):
            begin, stop = m.copy(), m.copy()
            full = np.flatnonzero(self.offsets[1:] > self.offsets[:-1])
            row_start, row_last = self.offsets[:-1][full], self.offsets[1:][full] - 1
            prev = np.empty_like(m)
            prev[0], prev[1:] = False, m[:-1]
            prev[row_start] = False
            begin &= ~prev
            prev[:-1], prev[-1] = m[1:], False
            prev[row_last] = False
            stop &= ~prev
            self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, self.offsets)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def sums(self) -> np.ndarray:
        """Running polynomial sums of the bytes; a difference is a substring's hash."""
        power, _ = _powers(_Q, len(self.data))
        value = np.where(self.is_word, _BYTE_VALUE, _U(0))[self.data]
        out = np.zeros(len(value) + 1, _U)
        np.cumsum(value * power[:len(value)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray | None = None, prefix: int | None = None) -> np.ndarray:
        """One 64-bit hash per word, or per its first ``prefix`` bytes."""
        c = self.sums() if sums is None else sums
        _, back = _powers(_Q, len(self.data))
        end = self.end if prefix is None else np.minimum(self.end, self.start + prefix)
        return mix((c[end] - c[self.start]) * back[self.start])

    def grams(self, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words of one row, and the index of the first
        word of each; rows with fewer words have none."""
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        power, back = _powers(_R, len(h) + 1)
        c = np.zeros(len(h) + 1, _U)
        np.cumsum(h * power[:len(h)], out=c[1:])
        at = np.flatnonzero(self.row[:n] == self.row[k - 1:])
        return mix((c[at + k] - c[at]) * back[at]), at

    def spans(self, h: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One hash per stretch of words [first, end)."""
        power, back = _powers(_R, len(h) + 1)
        c = np.zeros(len(h) + 1, _U)
        np.cumsum(h * power[:len(h)], out=c[1:])
        return mix((c[end] - c[first]) * back[first] + (end - first).astype(_U))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    m, span = x, 1
    while span * 2 <= w:
        m = np.minimum(m[:len(m) - span], m[span:])
        span *= 2
    rest = w - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m

