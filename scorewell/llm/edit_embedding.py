"""Document fingerprints by a randomised edit embedding.

All texts share one random walk: at position p of the embedding the current
character is copied out, and a shared random bit of (p, character) says whether
the reader moves on.  Two texts walk apart at an edit and soon fall into step
again, so a small edit distance becomes a small Hamming distance (and unrelated
texts stay apart).  The fingerprint is the embedding at shared sampled
positions, 64 in each doubling of the length, so texts of any length are
covered whole and comparable; one hex digit per position.  ``likeness`` is the
share of the embedding on which two fingerprints agree; ``near_classes`` and
``near_pairs`` find similar texts by bands of sampled positions and verify by
likeness.

The walk has period ``PERIOD``: every position is a list indexed by character
class that holds the next position's list, so a text is walked inside
``itertools.accumulate`` without a Python step per character.

Defined results: null text is the empty text, whose fingerprint is empty (alike
1 to another empty one, 0 to any other); the order of "next" is descending
doc_id, null ids last, equal ids in the order of a hash of the text; the last
row's next is the first, also when it is the only one; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import shuffle_partitions, staged
from scorewell.llm.components import components

PERIOD = 1024
SAMPLES = 64        # positions per doubling
BLOCKS = 27         # doublings: embeddings of up to 64 * 2**26 positions
BANDS, BAND_DIGITS = 40, 6
BLOCK = 64          # classes compared as one block
PIECE_CHARS = 1 << 21

_rng = np.random.default_rng(77031)
_MOVE = _rng.random((PERIOD, 256)) < 0.5
_DIGIT = _rng.integers(0, 16, (256, SAMPLES * BLOCKS), dtype=np.uint8)
#: sampled positions: the first 64, then 64 of each next doubling
POSITIONS = np.concatenate([np.arange(SAMPLES)] + [
    np.sort(_rng.choice(SAMPLES << k, SAMPLES, replace=False).astype(np.int64)) + (SAMPLES << k) for k in range(BLOCKS - 1)])
WEIGHT = np.repeat([1.0] + [2.0 ** k for k in range(BLOCKS - 1)], SAMPLES)
_BAND_AT = _rng.integers(0, SAMPLES * 2, (BANDS, BAND_DIGITS))


def _walk_table() -> list[list]:
    """node[p][c] is the node where the reader stands after character c was
    read from position p; node[p][256] is p."""
    nodes: list[list] = [[] for _ in range(PERIOD)]
    after = np.zeros((PERIOD, 256), np.int64)
    for c in range(256):
        ones = np.flatnonzero(_MOVE[:, c])
        nxt = ones[np.searchsorted(ones, np.arange(PERIOD)) % len(ones)]
        after[:, c] = (nxt + 1) % PERIOD
    for p in range(PERIOD):
        nodes[p].extend(nodes[q] for q in after[p].tolist())
        nodes[p].append(p)
    return nodes


_nodes: list[list] = []


def classes(text: str) -> bytes:
    """Character classes: the code point below 256, a hash of it above."""
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if cp.size and cp.max() > 255:
        cp = np.where(cp < 256, cp, (cp * np.uint32(2654435761)) >> np.uint32(24))
    return cp.astype(np.uint8).tobytes()


def leave_positions(chars: bytes, start: int = 0) -> np.ndarray:
    """Embedding position after each character, for a reader at ``start``."""
    if not _nodes:
        _nodes.extend(_walk_table())
    at = np.fromiter(map(itemgetter(256), accumulate(chars, getitem, initial=_nodes[start % PERIOD])), np.int64, len(chars) + 1)
    step = np.diff(at)
    step[step <= 0] += PERIOD
    return start + np.cumsum(step)


def sample(chars: bytes, leave: np.ndarray) -> bytes:
    """Fingerprint digits (0..15) at the sampled positions of an embedding."""
    if not len(leave):
        return b""
    n = int(np.searchsorted(POSITIONS, leave[-1]))
    c = np.frombuffer(chars, np.uint8)[np.searchsorted(leave, POSITIONS[:n], "right")]
    return _DIGIT[c, np.arange(n)].tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Share of the longer embedding on which two fingerprints agree."""
    n, m = len(a), min(len(a), len(b))
    n = max(n, len(b))
    if not n:
        return 1.0
    same = np.frombuffer(a, np.uint8, m) == np.frombuffer(b, np.uint8, m) if m else np.zeros(0, bool)
    return float(WEIGHT[:m][same].sum() / WEIGHT[:n].sum())


def _hex(digits: bytes) -> str:
    return digits.translate(b"0123456789abcdef" + bytes(240)).decode()


_UNHEX = bytes.maketrans(b"0123456789abcdef", bytes(range(16)))


def fingerprint(text: str) -> str:
    c = classes(text)
    return _hex(sample(c, leave_positions(c)))


def _next_pairs(rows: Iterator[tuple]) -> Iterator[tuple[tuple, tuple]]:
    """(row, next row) of sorted rows (bucket, extra, doc_id, text); a bucket
    ends with the row that follows its last one elsewhere (``extra``)."""
    held = None
    for r in rows:
        if held is not None and not held[1]:
            yield held, r
        held = r if not (r[1] and held is not None and held[1] and held[0] == r[0]) else held


def _in_order(docs: DataFrame, id_col: str, text: str) -> tuple[DataFrame, int]:
    """Rows in buckets of descending id ranges, each with its follower."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    buckets = 3 * n
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    at = [k / buckets for k in range(1, buckets)]
    cut = src.agg(F.percentile_approx("doc_id", at, 10_000).alias("c")).first()["c"] or []
    cut = sorted(set(cut))  # at most three numbers per shuffle partition
    lits = F.array(*[F.lit(x) for x in cut]) if cut else None

    def bucket(c: Column) -> Column:
        return F.when(c.isNull(), F.lit(-1)).otherwise(F.size(F.filter(lits, lambda x: x <= c)) if cut else F.lit(0))

    keyed = src.withColumn("bucket", bucket(F.col("doc_id")))
    first = keyed.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).orderBy("bucket").collect()  # one row per bucket
    follow = [(b["bucket"], first[i - 1]["doc_id"]) for i, b in enumerate(first)]  # -1 wraps to the highest ids
    kind = src.schema["doc_id"].dataType.simpleString()
    ends = spark.createDataFrame(follow, f"to_bucket int, first_id {kind}")
    extra = src.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("first_id"))) \
        .select(F.col("to_bucket").alias("bucket"), F.lit(True).alias("extra"), "doc_id", "text")
    every = keyed.select("bucket", F.lit(False).alias("extra"), "doc_id", "text").unionByName(extra)
    return every.repartition(n, "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")), n


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of each text (no shuffle)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t or "") for t in b.column(1).to_pylist()], pa.string())],
                names=["doc_id", "fingerprint"])

    return src.mapInArrow(run, f"doc_id {src.schema[0].dataType.simpleString()}, fingerprint string")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text whose second half is replaced by
    the start of the next one, with their likeness and that to the next text."""
    rows, _n = _in_order(docs, id_col, text)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        def emit(out):
            cols = list(zip(*out))
            types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            ids = pa.array(cols[0]) if any(x is not None for x in cols[0]) else pa.nulls(len(out))
            return pa.RecordBatch.from_arrays([ids.cast(id_type)] + [pa.array(c, t) for c, t in zip(cols[1:], types[1:])], names=names)

        out, size = [], 0
        known = None  # (text, classes, leave positions, digits) of the row that comes next
        for (_b, _e, doc_id, t), (_b2, _e2, _id2, nxt) in _next_pairs(flat()):
            t, nxt = t or "", nxt or ""
            if known is None or known[0] is not t and known[0] != t:
                c = classes(t)
                leave = leave_positions(c)
                known = (t, c, leave, sample(c, leave))
            _t, c, leave, own = known
            cn = classes(nxt)
            ln = leave_positions(cn)
            following = (nxt, cn, ln, sample(cn, ln))
            n = len(t)
            keep = n - n // 2
            tail = nxt[:n // 2]
            ct = cn[:n // 2]
            start = int(leave[keep - 1]) if keep else 0
            changed = sample(c[:keep] + ct, np.concatenate([leave[:keep], leave_positions(ct, start)]))
            out.append((doc_id, n, sha256((t[:keep] + tail).encode()).hexdigest(), _hex(own), _hex(changed),
                        likeness(own, changed), likeness(own, following[3])))
            known = following
            size += n
            if size > PIECE_CHARS:
                yield emit(out)
                out, size = [], 0
        if out:
            yield emit(out)

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")


def band_rows(classes: DataFrame) -> DataFrame:
    """(cid, bucket): ``BANDS`` groups of sampled digits on each of two levels.

    A long fingerprint is banded on its last two pairs of whole blocks, one under two
    blocks on its first 2**k digits for the two largest such k, so that texts of about
    one length, short ones included, share a level."""
    n = F.length("fingerprint")
    top = F.floor(n / SAMPLES).cast("int")
    small = F.floor(F.log2(n.cast("double")) + 1e-9).cast("int")
    span = lambda first, size: F.struct(first.alias("first"), size.alias("size"))
    head = lambda k: span(F.lit(0), F.pow(F.lit(2.0), F.greatest(k, F.lit(0))).cast("int"))
    pair = lambda t: F.when(t >= 2, span((t - 2) * SAMPLES, F.lit(2 * SAMPLES))).otherwise(head(F.lit(6)))
    spans = F.array_distinct(F.when(top >= 2, F.array(pair(top), pair(top - 1))).otherwise(F.array(head(small), head(small - 1))))
    lv = classes.select("cid", "fingerprint", F.explode(spans).alias("s"))
    at = lambda p: F.substring("fingerprint", F.col("s.first") + F.pmod(F.lit(int(p)), F.col("s.size")) + 1, F.lit(1))
    keys = F.array(*[F.xxhash64(F.lit(i), "s.first", "s.size", *[at(p) for p in places]) for i, places in enumerate(_BAND_AT)])
    return lv.select("cid", F.explode(F.array_distinct(keys)).alias("bucket"))


def _verified(pairs: DataFrame, least: float) -> DataFrame:
    """Links (a, b, likeness) of rows with two lists of (cid, root, fingerprint): pairs of
    different roots, the right one's name above the left one's unless its root is the main one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for left, right in zip(x.column(0).to_pylist(), x.column(1).to_pylist()):
                coded = [(r, r["fingerprint"].encode().translate(_UNHEX)) for r in right]
                for p in left:
                    own = p["fingerprint"].encode().translate(_UNHEX)
                    for q, other in coded:
                        if p["root"] != q["root"]:
                            v = likeness(own, other)
                            if v >= least:
                                out.append((p["cid"], q["cid"], v))
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                             names=["a", "b", "likeness"])

    return pairs.mapInArrow(run, "a bigint, b bigint, likeness double")


def _classes(prints: DataFrame) -> DataFrame:
    """Equal fingerprints are one class: (cid, fingerprint, first_id)."""
    return staged(prints.where(F.length("fingerprint") > 0).groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
                  .withColumn("cid", F.monotonically_increasing_id()), "print-classes")


def _links(cls: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(verified links, component of each linked class).

    Each bucket's most connected class meets all others of the bucket.  Where a
    bucket then still holds several components, the classes outside its largest one
    meet all of its classes, in blocks, so two alike classes of a bucket end up in
    one component whichever of them the stars tried."""
    bands = band_rows(cls)
    many = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(bands.join(many, "bucket"), "print-buckets")
    weight = shared.groupBy("cid").agg(F.sum(F.col("size") - 1).alias("weight"))
    heads = shared.join(weight, "cid").groupBy("bucket").agg(F.max_by("cid", F.struct("weight", "cid")).alias("head"))
    star = shared.join(heads, "bucket").where("cid <> head").select(F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()
    one = lambda c: cls.select(F.col("cid").alias(c), F.array(F.struct("cid", F.col("cid").alias("root"), "fingerprint")).alias(f"{c}_items"))
    links = staged(_verified(star.join(one("a"), "a").join(one("b"), "b").select("a_items", "b_items"), least), "print-links")
    roots = staged(components(links), "print-roots")
    of = shared.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("bucket", "cid", F.coalesce("root", "cid").alias("root"))
    main = of.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket") \
        .agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("roots"), F.sum("k").alias("n")).where("roots > 1")
    rest = staged(of.join(main, "bucket").join(cls.select("cid", "fingerprint"), "cid").select(
        "bucket", "cid", "root", "main", "fingerprint", F.ceil(F.col("n") / BLOCK).alias("blocks")), "print-rest")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    items = F.collect_list(F.struct("cid", "root", "fingerprint"))
    left = rest.where("root <> main").groupBy("bucket", "blocks", block.alias("i")).agg(items.alias("left")) \
        .withColumn("j", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    right = rest.groupBy("bucket", block.alias("j")).agg(items.alias("right"))
    more = staged(_verified(left.join(right, ["bucket", "j"]).select("left", "right"), least).dropDuplicates(["a", "b"]), "print-links")
    links = links.unionByName(more)
    return links, (roots if more.isEmpty() else components(links))


def near_pairs(prints: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, other_id, likeness): verified links between classes of equal
    fingerprints, each named by its smallest id (``near_classes`` has the members).

    Of alike classes in one bucket, enough links are returned to connect them all."""
    cls = _classes(prints)
    links, _roots = _links(cls, least)
    name = lambda c, out: cls.select(F.col("cid").alias(c), F.col("first_id").alias(out))
    both = links.join(name("a", "x"), "a").join(name("b", "y"), "b")
    return both.select(F.greatest("x", "y").alias("doc_id"), F.least("x", "y").alias("other_id"), "likeness").distinct()


def near_classes(prints: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, near_class) for every row of (doc_id, fingerprint): the smallest id of the
    documents reachable through fingerprints alike by ``least``.

    An empty or null fingerprint is a class of its own id; rows with null ids take part
    but never name a class; equal fingerprints are together; an empty table gives no rows."""
    cls = _classes(prints)
    _found, roots = _links(cls, least)
    named = cls.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    first = named.groupBy("root").agg(F.min("first_id").alias("near_class"))
    of = named.join(first, "root").select(F.col("fingerprint").alias("_fp"), "near_class")
    whole = prints.join(of, F.col("fingerprint") == F.col("_fp"), "left")
    return whole.select("doc_id", F.when(F.length("fingerprint") > 0, F.col("near_class")).otherwise(F.col("doc_id")).alias("near_class"))
