"""BPE encoding of long unsplit text by tree concatenation, and decoding.

Text that a pre-tokenizer does not split makes one long merge problem.  Here each text
(``encode_column``), and within it each stretch that is not split (``encode``), is cut in halves down to leaves, the leaves are encoded as one batch (in
parallel threads where the library may use them), and results are joined
pairwise up the tree: a window around each join is encoded anew and grows until
its tokens agree exactly with both sides; the agreed stretches are where left,
window and right are spliced.

A window that reaches both outer ends is the whole text, so the loop always
ends with the library's own result.  Why agreement suffices: a token sequence
is the encoding of its text when each pair of neighbours occurs in a right
encoding; after splicing inside agreed tokens every pair comes from one of the
three right encodings.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 1024    # characters
WINDOW = 64    # characters on each side of a join at first
AGREE = 4      # tokens that must be equal on each side


def _tokens(t, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    out = []
    for e in t.encode_batch(texts, add_special_tokens=False):
        out.append([(i, a, b) for i, (a, b) in zip(e.ids, e.offsets)])
    return out


def _shift(tokens, by: int):
    return [(i, a + by, b + by) for i, a, b in tokens]


def _agree_left(left, window, edge: int, join: int, at_start: bool) -> tuple[int, int] | None:
    """(tokens of left to keep, first window token after them): AGREE equal
    tokens in a row that begin inside the window and end before the join."""
    if at_start:
        return 0, 0
    index = {}
    for k, x in enumerate(left):
        if x[1] > edge and x[2] < join:
            index.setdefault(x, []).append(k)
    for w in range(len(window) - AGREE + 1):
        for k in index.get(window[w], ()):
            if left[k:k + AGREE] == window[w:w + AGREE] and left[k + AGREE - 1][2] < join:
                return k + AGREE, w + AGREE
    return None


def _agree_right(right, window, edge: int, join: int, at_end: bool) -> tuple[int, int] | None:
    """(window tokens to keep, first token of right after them)."""
    if at_end:
        return len(window), len(right)
    index = {}
    for k, x in enumerate(right):
        if x[1] > join and x[2] < edge:
            index.setdefault(x, []).append(k)
        elif x[1] >= edge:
            break
    for w in range(len(window) - AGREE, -1, -1):
        for k in index.get(window[w], ()):
            if right[k:k + AGREE] == window[w:w + AGREE] and right[k + AGREE - 1][2] < edge:
                return w + AGREE, k + AGREE
    return None


def _join(t, text: str, left, right, lo: int, mid: int, hi: int):
    """Tokens of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
    width = WINDOW
    while True:
        a, b = max(lo, mid - width), min(hi, mid + width)
        window = _shift(_tokens(t, [text[a:b]])[0], a)
        x = _agree_left(left, window, a, mid, a == lo)
        y = _agree_right(right, window, b, mid, b == hi)
        if x and y and x[1] <= y[0]:
            return left[:x[0]] + window[x[1]:y[0]] + right[y[1]:]
        if a == lo and b == hi:
            return window
        width *= 2


def encode(t, text: str, leaf: int = LEAF) -> list[int]:
    """Ids of a text, equal to ``t.encode(text, add_special_tokens=False).ids``."""
    cuts = list(range(0, len(text), leaf)) + [len(text)]
    spans = list(zip(cuts[:-1], cuts[1:]))
    if not spans:
        return []
    parts = [(a, b, _shift(x, a)) for (a, b), x in zip(spans, _tokens(t, [text[a:b] for a, b in spans]))]
    while len(parts) > 1:
        up = [(l[0], r[1], _join(t, text, l[2], r[2], l[0], l[1], r[1])) for l, r in zip(parts[::2], parts[1::2])]
        parts = up + (parts[-1:] if len(parts) % 2 else [])
    return [i for i, _a, _b in parts[0][2]]


def decode(t, ids: list[int]) -> str:
    return t.decode(ids, skip_special_tokens=False)


def _units(starts: np.ndarray, end: int, counts: np.ndarray, ids: np.ndarray) -> list[tuple]:
    """(first byte, last byte, ids) of units that follow each other."""
    s, flat, out, at = starts.tolist(), ids.tolist(), [], 0
    for a, b, n in zip(s, s[1:] + [end], counts.tolist()):
        out.append((a, b, tuple(flat[at:at + n])))
        at += n
    return out


def _run(part: list[tuple], window: list[tuple], back: bool = False) -> tuple[int, int] | None:
    """Places in part and window after (``back``: before) the first (last) equal units
    in a row with AGREE tokens."""
    at, tokens = {u: i for i, u in enumerate(part)}, 0
    for w in (range(len(window) - 1, -1, -1) if back else range(len(window))):
        i = at.get(window[w])
        tokens = 0 if i is None else tokens + len(window[w][2])
        if tokens >= AGREE:
            return (i, w) if back else (i + 1, w + 1)
    return None


class _Part:
    """An encoded stretch of a text: bytes lo to hi, its units' first bytes and token counts, its ids."""

    def __init__(self, lo, hi, starts, counts, ids):
        self.lo, self.hi, self.starts, self.counts, self.ids = lo, hi, starts, counts, ids

    def cut(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = int(self.counts[:i].sum())
        return self.starts[i:j], self.counts[i:j], self.ids[a:a + int(self.counts[i:j].sum())]


def _spliced(left: _Part, right: _Part, window: _Part) -> _Part | None:
    """The parts joined where they agree with the window around the join, or None."""
    mid, all_units = left.hi, _units(window.starts, window.hi, window.counts, window.ids)
    x, y = (0, 0), (len(right.starts), len(all_units))
    if window.lo > left.lo:
        i = int(np.searchsorted(left.starts, window.lo, "right"))
        x = _run(_units(left.starts[i:], mid, *left.cut(i, None)[1:])[:-1], all_units)  # the last unit touches the join
        x = x and (i + x[0], x[1])
    if window.hi < right.hi:
        i, j = (int(np.searchsorted(right.starts, at, "right")) for at in (mid, window.hi - 1))
        end = int(right.starts[j]) if j < len(right.starts) else right.hi
        y = _run(_units(right.starts[i:j], end, *right.cut(i, j)[1:]), all_units, back=True)
        y = y and (i + y[0], y[1])
    if not x or not y or x[1] > y[1]:
        return None
    parts = left.cut(0, x[0]), window.cut(x[1], y[1]), right.cut(y[0], None)
    return _Part(left.lo, right.hi, *(np.concatenate(c) for c in zip(*parts)))


def _whole_characters(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places moved back to the first byte of their character."""
    for _ in range(3):
        at = at - ((at < len(raw)) & ((raw[np.minimum(at, len(raw) - 1)] & 0xC0) == 0x80))
    return at


def encode_column(enc, column: pa.Array, leaf: int = LEAF, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first id of each row and one entry more) of a text column by tree concatenation.

    Every text is cut into leaves of ``leaf`` bytes, wherever they end; all leaves of the
    column are one batch.  Then neighbours are joined pairwise, level by level: the windows
    around a level's joins are one batch, and a window grows until its units (stretches
    with tokens of their own) agree on both sides of the join, or it is all of both parts.
    """
    from scorewell.llm.textbytes import buffers
    raw, offsets = buffers(column)
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    per = np.maximum(1, -(-np.diff(offsets) // leaf))
    first = np.concatenate([[0], np.cumsum(per)])
    row = np.repeat(np.arange(len(per)), per)
    edges = offsets[row] + leaf * (np.arange(first[-1]) - first[row])
    edges = np.append(np.maximum(offsets[row], _whole_characters(raw, edges)), len(raw))

    def batch(body: np.ndarray, cut: np.ndarray):
        text = pa.Array.from_buffers(pa.large_string(), len(cut) - 1, [None, pa.py_buffer(np.ascontiguousarray(cut, np.int64)), pa.py_buffer(np.ascontiguousarray(body))])
        e = enc.encode(text)
        return [_Part(int(cut[i]), int(cut[i + 1]), e.starts[a:b], e.unit_tokens[a:b], e.ids[s:t]) for i, (a, b, s, t) in
                enumerate(zip(e.row_units.tolist(), e.row_units[1:].tolist(), e.row_tokens.tolist(), e.row_tokens[1:].tolist()))]

    parts = batch(raw, edges)
    rows = [parts[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]
    while True:
        joins = [[r, i, window] for r, p in enumerate(rows) for i in range(0, len(p) - 1, 2)]
        if not joins:
            break
        done = {}
        while joins:
            span = np.array([(max(rows[r][i].lo, rows[r][i].hi - w), min(rows[r][i + 1].hi, rows[r][i].hi + w)) for r, i, w in joins])
            low = np.maximum([rows[r][i].lo for r, i, _w in joins], _whole_characters(raw, span[:, 0]))
            high = np.where(span[:, 1] < [rows[r][i + 1].hi for r, i, _w in joins], _whole_characters(raw, span[:, 1]), span[:, 1])
            cut = np.concatenate([[0], np.cumsum(high - low)])
            again = []
            for (r, i, w), a, win in zip(joins, low.tolist(), batch(np.concatenate([raw[a:b] for a, b in zip(low, high)]), cut)):
                win.starts = win.starts + (a - win.lo)
                win.lo, win.hi = a, a + win.hi - win.lo
                got = _spliced(rows[r][i], rows[r][i + 1], win)
                if got is None:
                    again.append([r, i, 2 * w])
                else:
                    done[r, i] = got
            joins = again
        rows = [[done.get((r, i), p[i]) for i in range(0, len(p), 2)] for r, p in enumerate(rows)]
    ids = [p[0].ids for p in rows]
    return np.concatenate(ids), np.concatenate([[0], np.cumsum([len(i) for i in ids])])


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ``ids``
    (array<int>) and ``decoded`` for each row.

    Defined results: null and empty text have no ids and decode to the empty
    text; repeated rows are encoded separately; null doc_id passes through; an
    empty table gives an empty result; only the named columns are read.  Texts
    are whole at any length; memory is bounded by a piece of a batch or the
    longest text.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scorewell.llm.textbytes import pieces
        from scorewell.llm.units import encoder
        enc = encoder(tokenizer_path, "word")
        joined = enc.t.decoder is None  # decoding is then the tokens joined by a blank
        for batch in batches:
            for b in pieces(batch):
                ids, at = encode_column(enc, b.column(1))
                ids = np.ascontiguousarray(ids, "<u4")
                view = memoryview(ids).cast("B")
                rows = [view[4 * x:4 * y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                if joined:
                    body, edge = enc.decoded(ids, at)
                    text = memoryview(np.ascontiguousarray(body))
                    back = [text[x:max(x, y - 1)] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
                else:
                    back = [decode(enc.t, ids[x:y].tolist()).encode() for x, y in zip(at[:-1], at[1:])]
                cols = [b.column(0), pa.array(np.diff(at)), pa.array([sha256(i).hexdigest() for i in rows]),
                        pa.array([sha256(d).hexdigest() for d in back])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))),
                             pa.array([bytes(d).decode() for d in back])]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"doc_id {src.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return src.mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
