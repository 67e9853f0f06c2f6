"""Encoding whole texts through context-free units.

A unit is a stretch of text whose tokens do not depend on its neighbours, so
the ids of a text are the ids of its units in order.  Both tokenizers used here
split at white space, which gives short units that repeat a lot; each Python
worker keeps a bounded table of units it has seen and encodes only new ones.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa

from scorewell.llm import bpe_tree
from scorewell.llm.textbytes import LOWER, buffers

MAX_KNOWN = 800_000   # units kept per worker and tokenizer; the table restarts when full
MAX_BYTES = 32 << 20  # bytes of units kept, likewise

#: white space (and characters that engines classify differently) beyond " " and "\n"
_ODD = "\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
_HAS_ODD = re.compile(f"[{_ODD}]")
_CUT = re.compile(f"(?<=[^ \n{_ODD}])(?=[ \n])")
_PLAIN = re.compile(rb"[ \n]*[^ \n]+|[ \n]+")
_PLAIN_WORD = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")

_LETTER, _MARK, _BLANK = 1, 2, 3


def _classes(blanks: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
    out[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = _MARK
    out[list(blanks)] = _BLANK
    return out


_KIND_CLASSES = {"spaced": _classes(b" \n"), "word": _classes(b" \t\n\r\x0b\x0c")}

#: characters that all engines classify alike: printable ASCII and Latin-1 letters
_COMMON = re.compile("[ \n!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: bytes of other characters, and "<"
_RARE = np.ones(256, bool)
_RARE[[10, *range(0x20, 0x3C), *range(0x3D, 0x7F), *range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0), 0xC3]] = False
_WORD_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")

#: fixed value: the split that byte-level tokenizers use before merging
_SPACED_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_loaded: dict[str, "Encoder"] = {}


def tokenizer(path: str):
    """The tokenizer of a file, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task has one core
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _odd_units(text: bytes, kind: str) -> list[bytes]:
    """Units of a text with unusual white space or the marks of a special token:
    cut at blanks only, joined they are the text."""
    if kind == "word":
        return _PLAIN_WORD.findall(text)
    if _HAS_ODD.search(text.decode()):
        return [u.encode() for u in _CUT.split(text.decode()) if u]
    return _PLAIN.findall(text)


_LEADS = np.zeros(256, bool)
_LEADS[[*b"<\t\x0b\x0c\r\x1c\x1d\x1e\x1f", 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True


def _odd_rows(raw: np.ndarray, offsets: np.ndarray, kind: str) -> np.ndarray:
    """Rows that hold ``<|`` or, for "spaced", a character of ``_ODD``."""
    at = np.flatnonzero(raw == 0x3C if kind == "word" else _LEADS[raw])
    if not len(at):
        return at
    a, b, c = raw[at].astype(np.int64), *(raw[np.minimum(at + k, len(raw) - 1)].astype(np.int64) for k in (1, 2))
    hit = (a == 0x3C) & (b == 0x7C)
    if kind == "spaced":
        code = (a << 16) | (b << 8) | c
        hit |= ((a < 0x20) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
                | np.isin(code, [0xE19A80, 0xE1A08E, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE281A0, 0xE38080, 0xEFBBBF])
                | ((code >= 0xE28080) & (code <= 0xE2808D)))
    return np.unique(np.searchsorted(offsets, at[hit], "right") - 1)


def unit_starts(raw: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of every unit of all rows, rows that were cut at blanks only).

    "spaced" is a byte-level tokenizer that lets a word keep the blank before it,
    "word" one that drops white space.  A cut before white space that follows a
    visible character, or between an ASCII letter and ASCII punctuation, never
    falls inside a token of either: only the last blank of a run joins the next
    word, a run's look-ahead stays within its unit, and letters and punctuation
    are never one pre-token.
    """
    kinds = _KIND_CLASSES[kind][raw]
    start = np.zeros(len(raw), bool)
    start[1:] = ((kinds[1:] == _BLANK) & (kinds[:-1] != _BLANK)) | ((kinds[1:] == _MARK) & (kinds[:-1] == _LETTER))
    odd = _odd_rows(raw, offsets, kind)
    for r in odd:
        lo, hi = int(offsets[r]), int(offsets[r + 1])
        start[lo:hi] = False
        size = [len(u) for u in _odd_units(raw[lo:hi].tobytes(), kind)]
        start[lo + np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)]).astype(np.int64)] = True
    start[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(start), odd


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def merge_core(t):
    """``str -> ids`` for units of common characters, by rank merging over the
    vocabulary of ``t``; None for a tokenizer of another make.

    A word-end mark is written as the byte 0xFF, which no UTF-8 text holds.
    """
    import tiktoken
    conf = json.loads(t.to_str())
    model, pre, norm = conf["model"], conf["pre_tokenizer"] or {}, conf["normalizer"]
    if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix"):
        return None
    suffix = model.get("end_of_word_suffix") or ""
    special = {a["content"] for a in conf["added_tokens"]}
    alphabet = _byte_alphabet()
    ranks = {}
    for token, i in model["vocab"].items():
        if token not in special:
            end = suffix and token.endswith(suffix) and len(token) > len(suffix)
            body = token[:-len(suffix)] if end else token
            ranks[bytes(alphabet[c] for c in body) + (b"\xff" if end else b"")] = i
    if pre.get("type") == "ByteLevel" and norm is None and not suffix and pre["use_regex"] and not pre["add_prefix_space"]:
        return tiktoken.Encoding("spaced", pat_str=_SPACED_SPLIT, mergeable_ranks=ranks,
                                 special_tokens={})._core_bpe.encode_ordinary
    steps = [p["type"] for p in pre.get("pretokenizers", [])]
    if steps == ["Split", "ByteLevel"] and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] \
            and suffix and pre["pretokenizers"][0]["pattern"]["Regex"] == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+":
        one = tiktoken.Encoding("word", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

        def encode(text: str) -> list[int]:
            return [i for w in _WORD_SPLIT.findall(text.lower().replace(" ", "").replace("\n", "")) for i in one(w.encode() + b"\xff")]

        return encode
    return None


class _Store:
    """Short arrays kept end to end; ``gather`` strings chosen ones together."""

    def __init__(self, kind):
        self.flat, self.first, self.n = np.zeros(1 << 12, kind), np.zeros(1 << 10, np.int64), 0

    def extend(self, values: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.first[self.n])
        need, rows = used + len(values), self.n + len(sizes) + 1
        if need > len(self.flat):
            self.flat = np.resize(self.flat, max(need, 2 * len(self.flat)))
        if rows > len(self.first):
            self.first = np.resize(self.first, max(rows, 2 * len(self.first)))
        self.flat[used:need] = values
        self.first[self.n + 1:rows] = used + np.cumsum(sizes)
        self.n = rows - 1

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.first[which + 1] - self.first[which]

    def gather(self, which: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.first[which] - (ends - sizes), sizes) + np.arange(total)]


class Encoded:
    """Ids of a column: ``ids``, the tokens of each unit, and per row its first
    unit and first token (one entry more than rows)."""

    def __init__(self, store: _Store, which: np.ndarray, row_units: np.ndarray, starts: np.ndarray):
        self.which, self.row_units, self.starts = which, row_units, starts
        self.unit_tokens = store.sizes(which)
        self.ids = store.gather(which, self.unit_tokens)
        self.row_tokens = np.concatenate([[0], np.cumsum(self.unit_tokens)])[row_units]


class Encoder:
    """Ids (unsigned 32-bit) and decoded text of units.

    A column's units are found on its byte buffer and made a dictionary by Arrow,
    so Python sees each different unit of a piece once.  Units of common characters
    go through ``merge_core``; all others, and any with a special token's marks,
    through the tree over the ``tokenizers`` library itself, where a unit within one
    leaf is encoded directly.
    """

    def __init__(self, path: str, kind: str):
        self.t = tokenizer(path)
        self.core = merge_core(self.t)
        self.kind = kind
        n = self.t.get_vocab_size(with_added_tokens=True)
        self.token = [(self.t.id_to_token(i) or "").encode() for i in range(n)] if self.t.decoder is None else None
        vocabulary = json.loads(self.t.to_str())["model"]["vocab"]
        self.spelled = None  # each token with the blank that parts it from the next
        if self.token is not None:
            spelled = [x + b" " for x in self.token]
            self.spelled = _Store(np.uint8)
            self.spelled.extend(np.frombuffer(b"".join(spelled), np.uint8), np.array([len(x) for x in spelled], np.int64))
        self.lengths = None  # bytes of each token, for a byte-level tokenizer
        if self.core is not None and kind == "spaced":
            self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.lengths[list(vocabulary.values())] = [len(k) for k in vocabulary]
        self._restart()

    def _restart(self) -> None:
        self.index: dict[bytes, int] = {}
        self.held = 0
        self.ids = _Store(np.uint32)

    def _learn(self, units: list[bytes], bulk: bool) -> None:
        """Add units, all of them new."""
        n = len(units)
        if not n:
            return
        if bulk:
            flat, sizes = self._bulk(units)
        else:
            core, common, rest = self.core, _COMMON.fullmatch, []
            out: list = [None] * n
            for i, u in enumerate(units):
                s = u.decode()
                if core is not None and len(s) <= bpe_tree.LEAF and common(s) and "<|" not in s:
                    out[i] = core(s)
                else:
                    rest.append((i, s))
            short = [x for x in rest if len(x[1]) <= bpe_tree.LEAF]
            for (i, _s), e in zip(short, self.t.encode_batch_fast([s for _i, s in short], add_special_tokens=False)):
                out[i] = e.ids
            for i, s in rest:
                if len(s) > bpe_tree.LEAF:
                    out[i] = bpe_tree.encode(self.t, s)
            parts = array("I")
            for ids in out:
                parts.extend(ids)
            flat, sizes = np.frombuffer(parts, np.uint32), np.array([len(x) for x in out], np.int64)
        self.ids.extend(flat, sizes)
        at = len(self.index)
        self.index.update(zip(units, range(at, at + n)))
        self.held += sum(map(len, units))

    def _bulk(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per unit) of common units of a byte-level tokenizer that begin
        with a blank, encoded as one text: between them are cuts that no token spans."""
        flat = np.array(self.core(b"".join(units).decode()), np.uint32)
        ends = np.concatenate([[0], np.cumsum(self.lengths[flat])])
        edge = np.cumsum([0, *map(len, units)])
        at = np.searchsorted(ends, edge)
        if not np.array_equal(ends[at], edge):
            raise AssertionError("a token spans two units")
        return flat, np.diff(at)

    def _known(self, body: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Numbers of the different units body[edge[i]:edge[i + 1]], all of them known afterwards."""
        text, cut = body.tobytes(), edge.tolist()
        units = [text[a:b] for a, b in zip(cut, cut[1:])]
        got = np.fromiter(map(self.index.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(got < 0)
        if len(new):
            if len(self.index) + len(new) > MAX_KNOWN or self.held > MAX_BYTES:
                self._restart()
                new = np.arange(len(units))
            plain = np.zeros(len(new), bool)
            if self.lengths is not None:
                odd = np.concatenate([[0], np.cumsum(_RARE[body])])
                blank = (body == 32) | (body == 10)
                plain = (odd[edge[new + 1]] == odd[edge[new]]) & blank[edge[new]] & ~blank[edge[new + 1] - 1]
            for some, bulk in ((new[plain], True), (new[~plain], False)):
                got[some] = len(self.index) + np.arange(len(some))
                self._learn([units[i] for i in some.tolist()], bulk)
        return got

    def encode(self, column: pa.Array) -> Encoded:
        """Ids of every row of a string column; null is the empty text."""
        raw, offsets = buffers(column)
        starts, odd = unit_starts(raw, offsets, self.kind)
        data = raw
        if self.kind == "word":  # lower case, as the tokenizer does
            data = LOWER[raw]
            for r in odd:
                data[offsets[r]:offsets[r + 1]] = raw[offsets[r]:offsets[r + 1]]
        row_units = np.searchsorted(starts, offsets)
        if not len(starts):
            return Encoded(self.ids, np.zeros(0, np.int64), row_units, starts)
        cut = np.append(starts, len(raw))
        units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(data))])
        coded = units.dictionary_encode()
        _, edge, body = coded.dictionary.buffers()
        which = self._known(np.frombuffer(body, np.uint8), np.frombuffer(edge, np.int64, len(coded.dictionary) + 1))[coded.indices.to_numpy()]
        return Encoded(self.ids, which, row_units, starts)

    def decoded(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, row offsets) of the rows ids[at[i]:at[i + 1]] decoded, each with a last
        blank if not empty: without a decoder, tokens are joined by a blank."""
        ids = ids.astype(np.int64)
        size = self.spelled.sizes(ids)
        return self.spelled.gather(ids, size), np.concatenate([[0], np.cumsum(size)])[at]


def encoder(path: str, kind: str) -> Encoder:
    """The worker's encoder for a file: kind "spaced" or "word"."""
    key = f"{kind}:{path}"
    if key not in _loaded:
        _loaded[key] = Encoder(path, kind)
    return _loaded[key]
