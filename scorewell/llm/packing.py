"""Best-fit packing by minimum bin slack.

Texts become pieces of at most ``capacity`` tokens.  Only the histogram of
piece lengths (at most ``capacity`` numbers, whatever the corpus) goes to the
driver, where each bin pattern is found: the longest length left, plus the
fullest combination of the others by a bitset subset-sum over the lengths still
available; the pattern is taken as often as its lengths last and then removed.
Pieces are ranked within their length on the executors (hashed buckets, so a
length that holds most rows is many small sorts) and look their place up in the
pattern table by (length, rank); no row is moved to its bin.

Defined results: null text is the empty text (one piece: the end id); repeated
rows are packed separately; an empty table gives no pieces; null doc_id passes
through; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import staged

CAPACITY = 1024
END_ID = 2
RANK_BUCKET_ROWS = 50_000
_RANK_BITS = 44


def tokenise(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
             id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every text.

    Texts over the capacity are cut into full pieces; the first may be shorter.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scorewell.llm.textbytes import PIECE_BYTES, pieces
        from scorewell.llm.units import encoder
        enc = encoder(tokenizer_path, "spaced")
        for batch in batches:
            for b in pieces(batch, limit=2 * PIECE_BYTES):
                e = enc.encode(b.column(1))
                ids, first = e.ids, e.row_tokens
                if end_id is not None:
                    ids, first = np.insert(ids, first[1:], end_id), first + np.arange(len(first))
                ids = np.ascontiguousarray(ids, "<u4")
                size = np.diff(first)
                head = np.where(size > 0, (size - 1) % capacity + 1, 0)  # of each row's first piece
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[row])
                at, view = first[:-1][row] + start, memoryview(ids).cast("B")
                crc = [crc32(view[4 * a:4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                cols = [b.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                        pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([view[4 * a:4 * (a + k)].tobytes() for a, k in zip(at.tolist(), length.tolist())], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                               + (", ids binary" if with_ids else ""))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths (with repeats) whose sum comes closest to ``room`` from below.

    ``reach`` is the bitset of sums; a length that occurs often is added in
    doubling bundles.  It stops at the first exact fit.
    """
    reach, mask = 1, (1 << (room + 1)) - 1
    steps = []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, bundle = min(counts[length], room // length), 1
        while left:
            take = min(bundle, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, bundle = left - take, bundle * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bin patterns and how many bins take each, fullest first within the
    longest length left."""
    left = {k: v for k, v in histogram.items() if v > 0}
    out = []
    while left:
        top = max(left)
        rest = dict(left)
        rest[top] -= 1
        if not rest[top]:
            del rest[top]
        pattern = fullest(rest, capacity - top)
        pattern[top] = pattern.get(top, 0) + 1
        times = min(left[k] // c for k, c in pattern.items())
        out.append((pattern, times))
        for k, c in pattern.items():
            left[k] -= c * times
            if not left[k]:
                del left[k]
    return out


def _table(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (key of length and first rank, first sequence, repeats, offset)."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        at = 0
        for length in sorted(pattern, reverse=True):
            first = used.get(length, 0)
            rows.append(((length << _RANK_BITS) | first, sequence, pattern[length], at))
            used[length] = first + pattern[length] * times
            at += length * pattern[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to staged pieces (read twice, so give a
    stable table: parquet or the result of ``staged``)."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = _table(plan(histogram, capacity))  # a few rows per length: bounded by the capacity
    total = sum(histogram.values())
    buckets = max(1, -(-total // RANK_BUCKET_ROWS))
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    p = pieces.withColumn("_bucket", F.pmod(key, F.lit(buckets)))
    size = p.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    size = size.select(F.col("length").alias("_length"), F.col("_bucket").alias("_b"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = p.withColumn("_in", F.row_number().over(order) - 1) \
        .join(size, (F.col("length") == F.col("_length")) & (F.col("_bucket") == F.col("_b"))) \
        .withColumn("_rank", F.col("_before") + F.col("_in")).drop("_bucket", "_length", "_b", "_before", "_in")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            rank = b.column(b.schema.get_field_index("_rank")).to_numpy()
            if not len(length):
                continue
            i = np.searchsorted(table[:, 0], (length << _RANK_BITS) | rank, "right") - 1
            k = rank - (table[i, 0] & ((1 << _RANK_BITS) - 1))
            sequence, slot = table[i, 1] + k // table[i, 2], k % table[i, 2]
            keep = [j for j, name in enumerate(b.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [b.column(j) for j in keep] + [pa.array(sequence), pa.array(table[i, 3] + slot * length)],
                names=[b.schema.names[j] for j in keep] + ["sequence_id", "offset"])

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, head + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that carry ``ids``: at most
    ``capacity`` tokens are gathered per sequence."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return parts.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_tokens"),
                        F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False,
                   **names: str) -> DataFrame:
    """Tokenise once into a staged table of pieces, then pack it."""
    return pack(staged(tokenise(docs, tokenizer_path, capacity, with_ids=with_ids, **names), "pieces"), capacity)
