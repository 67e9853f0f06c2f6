"""MinHash near-duplicates with sequential Bayesian verification.

1. One scan gives each text's set of word shingles as a 128-bit set hash, its
   size and a MinHash signature; equal sets are one class, whatever their number
   of copies.
2. Classes that agree on a band of the signature share a bucket.  Only buckets
   of two or more classes go on.
3. Candidates are stars: each bucket's most connected class against the rest.
   Signatures are compared batch by batch; a pair is dropped as soon as the
   posterior probability that its similarity reaches the threshold falls below
   the chosen miss probability.  Survivors are verified on the full sets.
4. Verified links give components.  Where a bucket still holds classes of more
   than one component, the classes outside its largest one are compared with
   all others of that component and with each other, in blocks of bounded size
   spread over tasks, with the same pruning and verification.  So no link
   between a bucket's members is lost to the stars, and a group of copies is
   never expanded into its pairs.

The banding misses a pair at the threshold with probability (1 - t**ROWS)**BANDS,
below 1e-6 for t = 0.8, and less for closer pairs.

Defined results: null text, or text without words, has the empty set: linked
with nothing, a component of its own; a single word is a set of one shingle;
repeated rows are equal sets; a null doc_id takes part, but is never a
component's smallest id (a component of null ids only has a null id and is
kept); an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import staged
from scorewell.llm.components import components
from scorewell.llm.textbytes import PLAIN_WORD, Words, mix, pieces

ROWS, BANDS = 5, 35
K = ROWS * BANDS
BATCH = 35             # signature values compared before each pruning
MISS = 1e-6            # posterior below which a candidate is dropped
BLOCK = 128            # classes compared as one block

_rng = np.random.default_rng(50023)
_A = _rng.integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, K, dtype=np.uint64)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row offsets): each row's distinct shingles, ascending; a text of
    fewer words is one shingle, of none the empty set."""
    w = Words(column, PLAIN_WORD, lower=True)
    h = w.hashes()
    g, at = w.grams(h, width)
    row = w.row[at]
    words = np.diff(w.first)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        one = [mix(np.array([np.bitwise_xor.reduce(mix(h[w.first[r]:w.first[r + 1]] + np.arange(1, words[r] + 1, dtype=np.uint64)))])) for r in short]
        g, row = np.concatenate([g, *one]), np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    if len(g):
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(w.rows + 1))


def signatures(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows with a set) x K minima, 16 bits of each."""
    full = np.flatnonzero(np.diff(off) > 0)
    out = np.zeros((len(full), K), np.uint16)
    at = off[:-1][full]
    for j in range(K if len(full) else 0):
        out[:, j] = np.minimum.reduceat((g * _A[j] + _B[j]) >> np.uint64(32), at) & np.uint64(0xFFFF)
    return out


def scan_sets(docs: DataFrame, width: int, id_col: str, text: str) -> DataFrame:
    """doc_id, th (text hash), cid and check (set hashes), n and the signature."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .withColumn("th", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch):
                g, off = shingle_sets(b.column(1), width)
                n = np.diff(off)
                c1, c2 = np.zeros(len(g) + 1, np.uint64), np.zeros(len(g) + 1, np.uint64)
                np.cumsum(mix(g + np.uint64(1)), out=c1[1:])
                np.cumsum(mix(g ^ np.uint64(0xABCDEF0123456789)), out=c2[1:])
                k1, k2 = (mix(c[off[1:]] - c[off[:-1]] + n.astype(np.uint64)).view(np.int64) for c in (c1, c2))
                sig: list[bytes | None] = [None] * b.num_rows
                for r, s in zip(np.flatnonzero(n > 0), signatures(g, off)):
                    sig[r] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array(k1), pa.array(k2), pa.array(n), pa.array(sig, pa.binary())],
                    names=["doc_id", "th", "cid", "check", "n", "sig"])

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, th bigint, cid bigint, check bigint, n bigint, sig binary")


def band_rows(classes: DataFrame) -> DataFrame:
    """(bucket, cid) for each band of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
            h = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
            for r in range(ROWS):
                h = mix(h + s[:, :, r] + np.uint64(r))
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)),
                                              b.column(0).take(pa.array(np.repeat(np.arange(len(s)), BANDS)))], names=["bucket", "cid"])

    return classes.select("cid", "sig").mapInArrow(run, "bucket bigint, cid bigint")


def prune_table(threshold: float, miss: float = MISS) -> dict[int, int]:
    """Compared values -> fewest matches with which a pair may go on.

    With a uniform prior, P(J >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in [*range(BATCH, K, BATCH), K]:
        tail, m = 0.0, 0
        while m <= n:
            tail += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log(1 - threshold))
            if tail >= miss:
                break
            m += 1
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the signature pairs that no batch prunes."""
    alive = np.arange(len(a))
    same = np.zeros(len(a), np.int64)
    done = 0
    for n, m in least.items():
        same[alive] += (a[alive, done:n] == b[alive, done:n]).sum(1)
        alive = alive[same[alive] >= m]
        done = n
    return alive


def _sigs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, K)


def prune_pairs(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) pairs whose signatures survive."""
    least = prune_table(threshold)
    j = pairs.join(classes.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a")), "a") \
        .join(classes.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b")), "b") \
        .where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")).select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                keep = pa.array(survivors(_sigs(x.column(2)), _sigs(x.column(3)), least))
                yield pa.RecordBatch.from_arrays([x.column(0).take(keep), x.column(1).take(keep)], names=["a", "b"])

    return j.mapInArrow(run, "a bigint, b bigint")


def verify_pairs(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity, exactly (in integers)."""
    t = texts.select("cid", "text")
    j = pairs.join(t.withColumnsRenamed({"cid": "b", "text": "text_b"}), "b") \
        .join(t.withColumnsRenamed({"cid": "a", "text": "text_a"}), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in pieces(batch, "text_a"):
                ga, oa = shingle_sets(x.column(2), width)
                gb, ob = shingle_sets(x.column(3), width)
                ok = []
                for i in range(x.num_rows):
                    p, q = ga[oa[i]:oa[i + 1]], gb[ob[i]:ob[i + 1]]
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    ok.append(100 * both >= percent * (len(p) + len(q) - both))
                keep = np.flatnonzero(ok)
                yield pa.RecordBatch.from_arrays([x.column(0).take(pa.array(keep)), x.column(1).take(pa.array(keep))], names=["a", "b"])

    return j.mapInArrow(run, "a bigint, b bigint")


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Each bucket's most connected class with every other class in it."""
    weight = shared.groupBy("cid").agg(F.sum(F.col("size") - 1).alias("weight"))
    heads = shared.join(weight, "cid").groupBy("bucket").agg(F.max_by("cid", F.struct("weight", "cid")).alias("head"))
    j = shared.join(heads, "bucket").where("cid <> head")
    return j.select(F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()


def common_counts(ga: np.ndarray, oa: np.ndarray, gb: np.ndarray, ob: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Intersection size of every left set with every right set.

    Only shingles on both sides count; they become the columns of two 0/1
    matrices, multiplied a slice of columns at a time (sums stay exact)."""
    out = np.zeros((len(oa) - 1, len(ob) - 1))
    shared = np.intersect1d(ga, gb)
    if not len(shared):
        return out

    def entries(g: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(shared, g), len(shared) - 1)
        hit = shared[at] == g
        row, col = np.repeat(np.arange(len(off) - 1), np.diff(off))[hit], at[hit]
        order = np.argsort(col, kind="stable")
        return row[order], col[order]

    (ra, ca), (rb, cb) = entries(ga, oa), entries(gb, ob)
    for lo in range(0, len(shared), columns):
        m = []
        for r, c, rows in ((ra, ca, len(oa) - 1), (rb, cb, len(ob) - 1)):
            x, y = np.searchsorted(c, (lo, lo + columns))
            d = np.zeros((rows, columns), np.float32)
            d[r[x:y], c[x:y] - lo] = 1
            m.append(d)
        out += m[0] @ m[1].T
    return out


def _rest_links(shared: DataFrame, roots: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components that meet in a bucket and that no star found.

    A bucket is named after its largest component.  The classes outside it
    (left) are compared with all its members and with each other (right), once
    per named component rather than once per bucket, in blocks of about BLOCK
    classes; signatures prune as before, survivors are verified on full sets,
    and one link per class and component leaves the task."""
    t = percent / 100
    r = shared.where("size > 2").join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("bucket", "cid", F.coalesce("root", "cid").alias("root"))
    main = r.groupBy("bucket", "root").agg(F.count("*").alias("k")).groupBy("bucket") \
        .agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count("*").alias("n_roots")).where("n_roots > 1").drop("n_roots")
    left = staged(r.join(main, "bucket").where("root <> main").select("main", "cid", "root").distinct(), "outside")
    if left.isEmpty():
        return left.select(F.col("cid").alias("a"), F.col("root").alias("b"))
    named = left.select("main").distinct()
    members = roots.join(named, F.col("root") == F.col("main")).select("main", F.col("node").alias("cid"), "root") \
        .unionByName(named.select("main", F.col("main").alias("cid"), F.col("main").alias("root")))
    right = left.unionByName(members).distinct()
    size = left.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("n_left")) \
        .join(right.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("n_right")), "main")
    body = classes.select("cid", "n", "sig").join(texts, "cid")

    def blocks(rows: DataFrame, count: str, salt: str, items: str) -> DataFrame:
        s = F.pmod(F.xxhash64("cid"), F.col(count)).alias(salt)
        return rows.join(size, "main").join(body, "cid") \
            .groupBy("main", "n_left", "n_right", s).agg(F.collect_list(F.struct("cid", "root", "n", "sig", "text")).alias(items))

    pairs = blocks(left, "n_left", "salt_a", "items").drop("n_left") \
        .withColumn("salt_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_right") - 1))).drop("n_right") \
        .join(blocks(right, "n_right", "salt_b", "items_b").drop("n_left", "n_right"), ["main", "salt_b"]).select("items", "items_b")
    least = prune_table(t)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(x.num_rows):
                p, q = (x.column(k).slice(i, 1).flatten() for k in (0, 1))
                (ca, ra, na, sa), (cb, rb, nb, sb) = [
                    [s.field(c).to_numpy() for c in ("cid", "root", "n")] + [_sigs(s.field("sig"))] for s in (p, q)]
                u, v = np.nonzero((ra[:, None] != rb[None, :]) & (np.minimum(na[:, None], nb[None, :]) >= t * np.maximum(na[:, None], nb[None, :])))
                kept = [at + survivors(sa[u[at:at + 32768]], sb[v[at:at + 32768]], least) for at in range(0, len(u), 32768)]
                if not kept or not sum(map(len, kept)):
                    continue
                kept = np.concatenate(kept)
                u, v = u[kept], v[kept]
                both = common_counts(*shingle_sets(p.field("text"), width), *shingle_sets(q.field("text"), width))[u, v]
                ok = 100 * both >= percent * (na[u] + nb[v] - both)
                u, v = u[ok], v[ok]
                _, one = np.unique(np.stack([ca[u], rb[v]]), axis=1, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(ca[u[one]]), pa.array(cb[v[one]])], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def _grouped(docs: DataFrame, width: int, percent: int, id_col: str, text: str) -> DataFrame:
    """Every row's (doc_id, th, n, root, component_id); the root names its component,
    null for an empty set."""
    t = percent / 100
    rows = staged(scan_sets(docs, width, id_col, text).withColumnRenamed("cid", "set_hash"), "sets")
    # a class is keyed by 128 bits of hash and its size, and then goes by a number
    classes = staged(rows.where("n > 0").groupBy("set_hash", "check", "n").agg(
        F.min(F.struct("doc_id", "th")).alias("rep"), F.min("doc_id").alias("first_id"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    bands = band_rows(classes)
    many = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(bands.join(many, "bucket"), "buckets")
    # texts of the classes that share a bucket, fetched once for both rounds
    need = shared.select("cid").distinct().join(classes.select("cid", "rep"), "cid") \
        .select("cid", F.col("rep.doc_id").alias("r_id"), F.col("rep.th").alias("r_th"))
    body = docs.select(F.col(id_col).alias("d_id"), F.col(text).cast("string").alias("text")).withColumn("d_th", F.xxhash64("text"))
    texts = staged(body.join(need, (F.col("d_th") == F.col("r_th")) & F.col("d_id").eqNullSafe(F.col("r_id")))
                   .select("cid", "text").dropDuplicates(["cid"]), "texts")
    tried = staged(prune_pairs(_star_pairs(shared), classes, t), "candidates")
    links = staged(verify_pairs(tried, texts, width, percent), "links")
    roots = staged(components(links), "roots")
    more = staged(_rest_links(shared, roots, classes, texts, width, percent), "links")
    if not more.isEmpty():
        # new links join whole components: run over the roots
        up = lambda c: F.coalesce(F.col(f"root_{c}"), F.col(c)).alias(c)
        j = more
        for c in ("a", "b"):
            j = j.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
        top = components(j.select(up("a"), up("b")))
        first = roots.join(top.select(F.col("root").alias("top"), F.col("node").alias("root")), "root", "left") \
            .select("node", F.coalesce("top", "root").alias("root"))
        roots = staged(first.unionByName(top.join(roots.select("node"), "node", "left_anti")), "roots")
    named = classes.select("cid", "set_hash", "check", "n", "first_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("root", F.coalesce("root", "cid"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = named.join(smallest, "root").select("set_hash", "check", "n", "root", "component_id")
    return rows.drop("sig").join(of, ["set_hash", "check", "n"], "left").select("doc_id", "th", "n", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, th (xxhash64 of the text), n_shingles, component_id and kept for
    every row: documents whose sets reach ``percent`` are linked."""
    out = _grouped(docs, width, percent, id_col, text)
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, with all its columns, of each component: that of the smallest id,
    null ids last, then of the smallest text hash.

    Rows without words are linked with nothing and stay; of rows equal in id and
    text one stays, also of these.  The row travels as a struct, so any column
    names will do; an empty table gives an empty result.
    """
    g = _grouped(docs, width, percent, id_col, text)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("s")
    stays = g.where("n > 0").groupBy("root").agg(first).select("s.doc_id", "s.th").unionByName(g.where("n = 0").select("doc_id", "th"))
    kept = stays.select(F.coalesce(F.xxhash64("doc_id"), F.lit(0)).alias("kid"), "th").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(whole, F.coalesce(F.xxhash64(id_col), F.lit(0)).alias("kid"), F.xxhash64(F.col(text).cast("string")).alias("th"))
    return keyed.join(kept, ["kid", "th"]).dropDuplicates(["kid", "th"]).select("row.*")
