"""Token counts that follow edits.

``build_trees`` encodes each text once and keeps the leaves of its tree: the
characters and tokens of each unit (a pre-token stretch that is encoded on its
own).  ``apply_edits`` lays a segment tree of subtree sums over blocks of
leaves, finds each edit's leaves by walking down the character sums, encodes
only the touched units with one untouched unit of context on either side, and
updates the sums on the path to the root.  The count after all edits is the
root; nothing else is encoded again.

Edits are an array of (start, n_delete, insert) per document, in code points of
the text as the edits before it left it.  A document and its edits are one row,
so nothing is shuffled and memory is bounded by the longest text.

Defined results: null text is the empty text, null edits are none; start and
length are clamped to the text, a null insert is empty; repeated rows are
counted separately; an empty table gives an empty result; a null doc_id passes
through; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 64  # leaves under one lowest inner node

EDITS = "array<struct<start:bigint,n_delete:bigint,insert:string>>"


class SegmentTree:
    """Subtree sums of (characters, tokens) over blocks of leaves.

    The number of blocks is fixed; a block's leaves may change, after which
    ``refresh`` updates its ancestors.
    """

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        cut = range(0, max(1, len(chars)), BLOCK)
        self.chars = [chars[a:a + BLOCK] for a in cut]
        self.tokens = [tokens[a:a + BLOCK] for a in cut]
        self.size = 1 << max(0, (len(cut) - 1).bit_length())
        self.n_chars, self.n_tokens = self._sums(chars, cut), self._sums(tokens, cut)
        edge = [0, *accumulate(self.n_chars[self.size:self.size + len(cut)])]
        self.text = [text[a:b] for a, b in zip(edge, edge[1:])]

    def _sums(self, values: np.ndarray, cut: range) -> list[int]:
        """The sums of all nodes, the root being number 1: lists, as they are read one by one."""
        level = np.zeros(self.size, np.int64)
        if len(values):
            level[:len(cut)] = np.add.reduceat(values, np.array(cut))
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(levels[-1][::2] + levels[-1][1::2])
        return [0, *(x for level in reversed(levels) for x in level.tolist())]

    def total(self) -> tuple[int, int]:
        return self.n_chars[1], self.n_tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """Block that holds character ``at`` and the characters before it."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if at - before >= self.n_chars[node] and self.n_chars[node + 1] > 0:
                before += self.n_chars[node]
                node += 1
        return min(node - self.size, len(self.chars) - 1), before

    def refresh(self, block: int) -> None:
        i = self.size + block
        more = int(self.chars[block].sum()) - self.n_chars[i], int(self.tokens[block].sum()) - self.n_tokens[i]
        while i:
            self.n_chars[i] += more[0]
            self.n_tokens[i] += more[1]
            i //= 2

    def whole(self) -> str:
        return "".join(self.text)

    def region(self, start: int, n_delete: int, insert: str) -> tuple[str, tuple]:
        """The text that one edit leaves to be encoded, and what ``replace`` needs with its leaves."""
        length = self.total()[0]
        start = min(max(0, start), length)
        stop = min(start + max(0, n_delete), length)
        first, before = self.find(max(0, start - 1))
        last, last_before = (first, before) if stop < before + len(self.text[first]) else self.find(min(stop, max(0, length - 1)))
        text = "".join(self.text[first:last + 1])
        chars = np.concatenate(self.chars[first:last + 1])
        tokens = np.concatenate(self.tokens[first:last + 1])
        edge = np.concatenate([[0], np.cumsum(chars)])
        # units of the characters beside the edit, and one untouched unit beyond
        i = max(0, int(np.searchsorted(edge, max(0, start - before - 1), "right")) - 2)
        j = min(len(chars), int(np.searchsorted(edge, stop - before, "right")) + 1)
        # context must not end at a block's edge unless the text ends there
        if i == 0 and first > 0:
            while first > 0 and i == 0:
                first -= 1
                text, before = self.text[first] + text, before - len(self.text[first])
                chars = np.concatenate([self.chars[first], chars])
                tokens = np.concatenate([self.tokens[first], tokens])
                i, j = max(0, len(self.chars[first]) - 1), j + len(self.chars[first])
        if j == len(chars):
            while last + 1 < len(self.chars) and j == len(chars):
                last += 1
                text += self.text[last]
                j = len(chars) + min(1, len(self.chars[last]))
                chars = np.concatenate([chars, self.chars[last]])
                tokens = np.concatenate([tokens, self.tokens[last]])
        edge = np.concatenate([[0], np.cumsum(chars)])
        a, b = int(edge[i]), int(edge[j])
        s, e = start - before, stop - before
        region = text[a:s] + insert + text[e:b]
        return region, (first, last, text[:a] + region + text[b:], chars[:i], chars[j:], tokens[:i], tokens[j:])

    def replace(self, place: tuple, new_chars: np.ndarray, new_tokens: np.ndarray) -> None:
        """Apply the edit of a ``region`` by the leaves of its text."""
        first, last, self.text[place[0]], *beside = place
        self.chars[first] = np.concatenate([beside[0], new_chars, beside[1]])
        self.tokens[first] = np.concatenate([beside[2], new_tokens, beside[3]])
        for k in range(first + 1, last + 1):
            self.text[k], self.chars[k], self.tokens[k] = "", new_chars[:0], new_tokens[:0]
        for k in range(first, last + 1):
            self.refresh(k)


def _leaves(raw: np.ndarray, e) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each unit of an encoded column."""
    if not len(e.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.add.reduceat((raw & 0xC0) != 0x80, e.starts, dtype=np.int64), e.unit_tokens


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Each row's numbers of a list column."""
    edge = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())]).tolist()
    flat = column.flatten().to_numpy().astype(np.int64)
    return [flat[a:b] for a, b in zip(edge, edge[1:])]


def build_trees(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                edits: str | None = None) -> DataFrame:
    """doc_id, text, ``unit_chars`` and ``unit_tokens`` (the leaves), n_tokens;
    the ``edits`` column rides along.  The result can be stored and edited later."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"),
                      (F.col(edits) if edits else F.lit(None)).cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scorewell.llm.textbytes import buffers, pieces
        from scorewell.llm.units import encoder
        enc = encoder(tokenizer_path, "spaced")
        for batch in batches:
            for b in pieces(batch):
                e = enc.encode(b.column(1))
                chars, tokens = _leaves(buffers(b.column(1))[0], e)
                off = pa.array(e.row_units.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2),
                     pa.ListArray.from_arrays(off, pa.array(chars.astype(np.int32))),
                     pa.ListArray.from_arrays(off, pa.array(tokens.astype(np.int32))), pa.array(np.diff(e.row_tokens))],
                    names=["doc_id", "text", "edits", "unit_chars", "unit_tokens", "n_tokens"])

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text string, edits {EDITS}, unit_chars array<int>, "
                               "unit_tokens array<int>, n_tokens bigint")


def apply_edits(trees: DataFrame, tokenizer_path: str, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens_before, n_tokens, n_edits, n_chars, n_chars_encoded,
    text_sha256 and, if wanted, the edited ``text`` and its new leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scorewell.llm.textbytes import buffers, pieces
        from scorewell.llm.units import encoder
        enc = encoder(tokenizer_path, "spaced")

        def count(regions: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """The leaves of each text; all are encoded as one column."""
            column = pa.array(regions, pa.large_string())
            e = enc.encode(column)
            chars, tokens = _leaves(buffers(column)[0], e)
            edge = e.row_units.tolist()
            return ((chars[a:b], tokens[a:b]) for a, b in zip(edge, edge[1:]))

        for batch in batches:
            for b in pieces(batch):
                texts, edits = [t or "" for t in b.column(1).to_pylist()], [x or [] for x in b.column(2).to_pylist()]
                trees = [SegmentTree(*x) for x in zip(texts, _lists(b.column(3)), _lists(b.column(4)))]
                before, encoded = [t.total()[1] for t in trees], [0] * len(trees)
                # the rows' edits go on side by side: the next of each row is located, and all are encoded at once
                left = [(i, iter([e for e in x if e is not None])) for i, x in enumerate(edits)]
                while left := [(i, rest, e) for i, rest, e in ((i, rest, next(rest, None)) for i, rest, *_ in left) if e is not None]:
                    found = [trees[i].region(e["start"] or 0, e["n_delete"] or 0, e["insert"] or "") for i, _rest, e in left]
                    for (i, *_), (region, place), new in zip(left, found, count([r for r, _place in found])):
                        trees[i].replace(place, *new)
                        encoded[i] += len(region)
                rows = []
                whole = [t.whole() for t in trees]
                # a special token may span units: such a text is cut at blanks only, so count it anew
                anew = [i for i, (text, x, new) in enumerate(zip(texts, edits, whole)) if x and ("<|" in new or "<|" in text)]
                for i, new in zip(anew, count([whole[i] for i in anew]) if anew else ()):
                    trees[i], encoded[i] = SegmentTree(whole[i], *new), encoded[i] + len(whole[i])
                for i, (tree, new) in enumerate(zip(trees, whole)):
                    n_chars, n_tokens = tree.total()
                    rows.append((before[i], n_tokens, len(edits[i]), n_chars, encoded[i], sha256(new.encode()).hexdigest())
                                + ((new, np.concatenate(tree.chars).astype(np.int32), np.concatenate(tree.tokens).astype(np.int32)) if with_text else ()))
                types = [pa.int64()] * 5 + [pa.string()] + ([pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())] if with_text else [])
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", *_OUT, *(["text", "unit_chars", "unit_tokens"] if with_text else [])])

    kind = trees.schema["doc_id"].dataType.simpleString()
    src = trees.select("doc_id", "text", "edits", "unit_chars", "unit_tokens")
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens_before bigint, n_tokens bigint, n_edits bigint, n_chars bigint, "
                               "n_chars_encoded bigint, text_sha256 string"
                               + (", text string, unit_chars array<int>, unit_tokens array<int>" if with_text else ""))


_OUT = ["n_tokens_before", "n_tokens", "n_edits", "n_chars", "n_chars_encoded", "text_sha256"]
