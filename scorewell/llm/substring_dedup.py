"""Substring dedup with suffix automata over reference shards.

A window is ``window`` consecutive words.  Every word that is covered by a
window whose words also start anywhere else, in the same document or another,
is removed.  The corpus is its own reference, so an automaton of everything,
broadcast to everyone, would grow with the corpus; instead the reference is cut
into shards of bounded size so that all places that can match are in one shard:

1. One scan cuts each text into runs: neighbouring windows with the same
   minimiser (smallest hash of ``GRAM`` words in the window).  Equal windows have
   equal minimisers.  A run is its minimiser, a hash of its words and its place.
2. Runs whose minimiser occurs once in the corpus cannot match and go.
3. Runs with equal words are one segment with a count; a count of two or more
   settles all its windows without reading them again.
4. The other segments (near copies, edges of shared passages) are the reference:
   their words are cut from the texts, once per segment, and dealt by minimiser
   to shards of about ``SHARD_WORDS`` words.  Each shard builds one suffix
   automaton of its segments and streams them through it: the matching
   statistics, held at the window length, give the number of places of every
   window, and the windows with two or more give the spans.
5. A minimiser with more than ``HOT`` different segments (a phrase in very many
   contexts) would not fit a shard: its windows are counted by their own hash
   in an aggregate instead, which is exact in the same way and splits evenly.
6. Spans are joined to the texts, and covered words are removed.

Hashes (64 bits, of minimiser, words and length together) only ever compare
segments of one minimiser; the automata compare the words themselves.

Defined results: null text has no words; a text shorter than a window keeps
all; repeated rows are places of their own, so they remove each other; a null
doc_id takes part; an empty table gives an empty result; only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import staged, unused
from scorewell.llm.textbytes import PLAIN_WORD, Words, pieces, sliding_min

WINDOW = 35
GRAM = 8
LONGEST_RUN = 64       # windows of one run
SHARD_WORDS = 30_000
HOT = 512              # different segments of one minimiser


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """doc_id, text and the key (kid, th).  Rows of one key have one text, and so
    one decision, even where a null id meets the id that stands in for it."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .select("doc_id", "text", F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("kid"), F.xxhash64("text").alias("th"))


def runs(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, rh, n, again, kid, th, at): runs of n windows from word ``at``; again
    marks runs with a window that may occur twice within it."""
    gram = min(GRAM, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                w = Words(b.column(0), PLAIN_WORD)
                h = w.hashes()
                win, at = w.grams(h, window)
                if not len(win):
                    continue
                x = np.full(len(h), np.iinfo(np.uint64).max)
                g, i = w.grams(h, gram)
                x[i] = g
                low = sliding_min(x, window - gram + 1)[at]
                row = w.row[at]
                new = np.ones(len(at), bool)
                new[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
                start = np.flatnonzero(new)
                inside = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
                start = np.flatnonzero(inside % LONGEST_RUN == 0)
                n = np.diff(np.append(start, len(at)))
                order = np.argsort(win)
                twice = np.zeros(len(win), bool)
                same = win[order][1:] == win[order][:-1]
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                first = at[start]
                r = row[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low[start].view(np.int64)), pa.array(w.spans(h, first, first + n + window - 1).view(np.int64)),
                     pa.array(n.astype(np.int32)), pa.array(np.logical_or.reduceat(twice, start)),
                     b.column(1).take(pa.array(r)), b.column(2).take(pa.array(r)), pa.array((first - w.first[r]).astype(np.int32))],
                    names=["h", "rh", "n", "again", "kid", "th", "at"])

    return keyed.select("text", "kid", "th").mapInArrow(
        run, "h bigint, rh bigint, n int, again boolean, kid bigint, th bigint, at int")


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with counts of places."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.len.append(length)
        self.count.append(0)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, size = self.next, self.link, self.len
        k = self._state(size[p] + 1, dict(nxt[q]), link[q])
        link[q] = k
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def add(self, words: list[int], times: int = 1) -> None:
        """Insert a segment that stands in ``times`` places."""
        nxt, link, size = self.next, self.link, self.len
        last = 0
        for c in words:
            q = nxt[last].get(c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._clone(last, q, c)
            else:
                cur = self._state(size[last] + 1, {}, 0)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[cur] = q if size[q] == size[p] + 1 else self._clone(p, q, c)
                last = cur
            self.count[last] += times

    def close(self) -> None:
        """Add up places along suffix links, longest states first."""
        for s in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def places(self, words: list[int], window: int) -> list[int]:
        """Matching statistics held at ``window`` words: for each window of a
        text, the number of places it has in the automaton (0: none)."""
        nxt, link, size = self.next, self.link, self.len
        s, length, out = 0, 0, []
        for i, c in enumerate(words):
            while s and c not in nxt[s]:
                s = link[s]
                length = size[s]
            if c in nxt[s]:
                s, length = nxt[s][c], length + 1
            while s and size[link[s]] >= window:
                s = link[s]
            length = min(length, size[s])
            if i >= window - 1:
                out.append(self.count[s] if length >= window else 0)
        return out


def shard_repeats(segments: list[tuple[str, int]], window: int) -> list[list[int]]:
    """For each (text, places) segment of a shard: its windows with two or more
    places.  Segments that already have two are reference only."""
    number: dict[str, int] = {}
    texts = [[number.setdefault(w, len(number)) for w in t.split(" ")] for t, _m in segments]
    a = SuffixAutomaton()
    for words, (_t, m) in zip(texts, segments):
        a.add(words, m)
    a.close()
    return [[i for i, k in enumerate(a.places(words, window)) if k >= 2] if m == 1 else []
            for words, (_t, m) in zip(texts, segments)]


def _cut(picked: DataFrame, window: int) -> DataFrame:
    """(h, rh, n, m, hot, text, windows): words of the segments a text stands for.
    Hot segments give hashes of their windows instead of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                w = Words(b.column(0), PLAIN_WORD)
                h = w.hashes()
                rows = []
                for r, want in enumerate(b.column(1).to_pylist()):
                    f = w.first[r]
                    for s in want:
                        i, e = f + s["at"], f + s["at"] + s["n"] + window - 1
                        if s["hot"]:
                            k = np.arange(i, i + s["n"])
                            rows.append((s["h"], s["rh"], s["n"], s["m"], None, w.spans(h, k, k + window).view(np.int64).tolist()))
                        else:
                            rows.append((s["h"], s["rh"], s["n"], s["m"],
                                         b" ".join([bytes(w.data[x:y]) for x, y in zip(w.start[i:e], w.end[i:e])]).decode(), None))
                if rows:
                    c = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.int64()),
                         pa.array(c[4], pa.string()), pa.array(c[5], pa.list_(pa.int64()))], names=["h", "rh", "n", "m", "words", "windows"])

    return picked.select("text", "want").mapInArrow(
        run, "h bigint, rh bigint, n int, m bigint, words string, windows array<bigint>")


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(keyed documents, (kid, th, spans)): the repeated windows of each text as
    ranges of window starts."""
    keyed = _keyed(docs, id_col, text)
    every = staged(runs(keyed, window), "runs")
    per_h = every.groupBy("h").agg(F.count("*").alias("k"), F.max("again").alias("any_again"))
    kept = staged(every.join(per_h.where("k > 1 or any_again").select("h"), "h"), "repeated-runs")

    segments = kept.groupBy("h", "rh", "n").agg(F.count("*").alias("m"), F.max("again").alias("again"),
                                                F.min(F.struct("kid", "th", "at")).alias("rep"))
    kinds = segments.groupBy("h").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("m") == 1, 1).otherwise(0)).alias("single"),
                                      F.max("again").alias("h_again")).where("single > 0 and (kinds > 1 or h_again)")
    open_ = staged(segments.join(kinds.select("h", "kinds"), "h"), "segments")
    words = open_.where(F.col("kinds") <= HOT).agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))

    wanted = open_.groupBy(F.col("rep.kid").alias("kid"), F.col("rep.th").alias("th")).agg(F.collect_list(F.struct(
        "h", "rh", "n", "m", F.col("rep.at").alias("at"), (F.col("kinds") > HOT).alias("hot"))).alias("want"))  # within one text
    # a row may stand twice in the table; its segments count once
    cut = _cut(keyed.join(wanted, ["kid", "th"]).select("text", "want"), window)

    def shard(batches: Iterator[pa.Table]) -> pa.Table:
        t = pa.concat_tables(batches) if not isinstance(batches, pa.Table) else batches
        seen: dict[tuple, tuple] = {}
        for h, rh, n, m, x in zip(*(t.column(c).to_pylist() for c in ("h", "rh", "n", "m", "words"))):
            seen[h, rh, n] = (x, m)
        hits = shard_repeats(list(seen.values()), window)
        rows = [(*k, i) for k, i in zip(seen, hits) if i]
        c = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.list_(pa.int32()))],
                        names=["h", "rh", "n", "hits"])

    cut = staged(cut, "reference")
    by_shard = cut.where("words is not null").withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)))
    found = by_shard.groupBy("shard").applyInArrow(shard, "h bigint, rh bigint, n int, hits array<int>")
    hot = cut.where("windows is not null").dropDuplicates(["h", "rh", "n"]) \
        .select("h", "rh", "n", "m", F.posexplode("windows").alias("i", "window"))
    twice = hot.groupBy("h", "window").agg(F.sum("m").alias("places")).where("places > 1").select("h", "window")
    hot_found = hot.where("m = 1").join(twice, ["h", "window"]).groupBy("h", "rh", "n").agg(F.collect_list("i").alias("hits"))
    settled = segments.where("m > 1").select("h", "rh", "n", F.lit(None).cast("array<int>").alias("hits"))
    verdict = settled.unionByName(found).unionByName(hot_found)

    spans = kept.join(verdict, ["h", "rh", "n"]).select("kid", "th", "at", "n", "hits") \
        .groupBy("kid", "th").agg(F.collect_list(F.struct("at", "n", "hits")).alias("spans"))  # within one text
    return keyed, spans


def _keep(w: Words, spans: list[list[dict] | None], window: int) -> np.ndarray:
    """Mask of the words that stay."""
    edge = np.zeros(len(w) + 1, np.int64)
    for r, s in enumerate(spans):
        if s:
            f = int(w.first[r])
            starts = np.concatenate([np.arange(x["at"], x["at"] + x["n"]) if x["hits"] is None else np.array(x["hits"], np.int64) + x["at"] for x in s]) + f
            starts = np.unique(starts)
            edge[starts] += 1
            np.subtract.at(edge, starts + window, 1)
    return np.cumsum(edge[:-1]) == 0


def kept_text(w: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets): the words that stay, joined by one space."""
    data = w.data.copy()
    mask = np.zeros(len(data) + 1, np.int8)
    np.add.at(mask, w.start[keep], 1)
    np.add.at(mask, w.end[keep], -1)
    take = np.cumsum(mask[:-1]).astype(bool)
    k = np.flatnonzero(keep)
    if len(k) > 1:
        joint = w.end[k[:-1]][w.row[k[:-1]] == w.row[k[1:]]]  # the blank after a word that another follows
        take[joint] = True
        data[joint] = 32
    size = np.zeros(len(take) + 1, np.int64)
    np.cumsum(take, out=size[1:])
    return data[take], size[w.offsets]


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if wanted, ``kept_text`` for
    every row (null where nothing was removed)."""
    keyed, spans = repeated_spans(docs, window, id_col, text)
    rows = keyed.join(spans, ["kid", "th"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                w = Words(b.column(1), PLAIN_WORD)
                keep = _keep(w, b.column(2).to_pylist(), window)
                body, off = kept_text(w, keep)
                gone = np.bincount(w.row[~keep], minlength=w.rows)
                out = [bytes(body[x:y]) for x, y in zip(off[:-1], off[1:])]
                cols = [b.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(gone.astype(np.int64)),
                        pa.array([sha256(x).hexdigest() for x in out])]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    cols.append(pa.array([x.decode() if g else None for x, g in zip(out, gone)], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
                                + (", kept_text string" if with_text else ""))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text: str = "text",
                   length: str | None = "n_chars") -> DataFrame:
    """The rows, with all their columns, without repeated passages.  A text that
    loses words is its other words joined by one space, and ``length`` (where
    there is such a column) its new length; other texts stay as they are.

    Null and empty texts stay; rows equal in id and text are treated alike; an
    empty table gives an empty result; any column names will do."""
    _keyed_docs, spans = repeated_spans(docs, window, id_col, text)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(whole, F.coalesce(F.xxhash64(id_col), F.lit(0)).alias("kid"), F.xxhash64(F.col(text).cast("string")).alias("th"))
    rows = keyed.join(spans, ["kid", "th"], "left").select("row.*", F.col("spans").alias(unused("spans", docs.columns)))
    at = docs.columns.index(text)
    size_at = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, text):
                w = Words(b.column(at), PLAIN_WORD)
                keep = _keep(w, b.column(len(b.columns) - 1).to_pylist(), window)
                body, off = kept_text(w, keep)
                gone = np.bincount(w.row[~keep], minlength=w.rows)
                old = b.column(at).to_pylist()
                new = [bytes(body[off[r]:off[r + 1]]).decode() if gone[r] else old[r] for r in range(w.rows)]
                cols = list(b.columns[:-1])
                cols[at] = pa.array(new, cols[at].type)
                if size_at is not None:
                    was = cols[size_at].to_pylist()
                    cols[size_at] = pa.array([len(t) if g else x for t, g, x in zip(new, gone, was)], cols[size_at].type)
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return rows.mapInArrow(run, docs.schema)
