"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only documents carry labels.  A sentence's
score is a logistic model over hashed words and word beginnings, and a document
is toxic if any sentence is (noisy-or): ``P = 1 - prod(1 - p_s)``.  The sentence
model is trained through the noisy-or from document labels alone, so afterwards
the sentences with a high score are the offending ones.

Fitting uses a bounded sample of labelled rows: per label, in the order of a
hash of the id, at most ``MAX_DOCS`` documents and ``MAX_WORDS`` words at six
characters each (the bound of what the driver holds).  A text longer than
``1 / SHARE`` of that budget is passed over and the next one in hash order takes
its place, so no text can displace the others; if all of a label's texts are that
long, they are taken from the shortest up, one at least.  With documents and labels
of both kinds, a label without any text to learn from is an error.  Everything else covers all rows and whole texts:
scoring is one pass over the table with the weights (2**20 floats, 4 MB, a fixed
bound) sent to the tasks.

Defined results: null or empty text has no sentences and the score
``EMPTY_SCORE``; rows without a label are scored only; repeated rows are
scored each, and used once each in training; a null doc_id joins
no label; an empty labels table gives a model that scores everything
about 0; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import staged, unused
from scorewell.llm.textbytes import LETTER_WORD, Words, byte_class, pieces

DIMENSIONS = 1 << 20
PREFIXES = (4, 5, 6)      # word beginnings, in bytes
MAX_DOCS = 3000           # per label
MAX_WORDS = 900_000       # per label
SHARE = 40                # one text may use a fortieth of the budget (135,000 characters)
MIN_DOCS = 3              # a feature in fewer training documents has no weight
EPOCHS = 200
PIECE = 1 << 19           # text bytes at a time; each word has up to four features
EMPTY_SCORE = 0.0
THRESHOLD = 0.3

SENTENCE = byte_class(b".!?\n")


@dataclass
class Model:
    weights: np.ndarray   # float32, DIMENSIONS
    bias: float


def features(column: pa.Array) -> tuple[Words, Words, np.ndarray, np.ndarray]:
    """(sentences, words, sentence index per feature, feature id) of a column."""
    s = Words(column, SENTENCE)
    w = Words(column, LETTER_WORD, lower=True)
    of = np.searchsorted(s.start, w.start, "right") - 1
    sums = w.sums()
    ids = [w.hashes(sums)]
    where = [of]
    size = w.end - w.start
    for k, p in enumerate(PREFIXES):
        long = size > p
        ids.append(w.hashes(sums, p)[long] + np.uint64(k + 1))
        where.append(of[long])
    f = (np.concatenate(ids) % np.uint64(DIMENSIONS)).astype(np.int32)
    return s, w, np.concatenate(where), f


def _sentence_scores(model: Model, column: pa.Array) -> tuple[Words, np.ndarray]:
    """Log-odds of each sentence; those without a known feature cannot offend."""
    s, _w, of, f = features(column)
    v = model.weights[f]
    z = np.bincount(of, weights=v, minlength=len(s)) + model.bias
    known = np.bincount(of, weights=v > 0, minlength=len(s)) > 0
    return s, np.where(known, z, -30.0)


def _bags(labelled: DataFrame) -> pa.Table:
    """(label, sentence per feature, feature) of the training rows, gathered on the
    driver (two 32-bit numbers per feature, bounded above)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in pieces(batch, limit=PIECE):
                s, _w, of, f = features(b.column(1))
                order = np.argsort(of, kind="stable")
                of, f = of[order], f[order]
                row = s.row[of] if len(s) else of
                cut = np.searchsorted(row, np.arange(b.num_rows + 1))
                inner = of - s.first[row] if len(of) else of
                off = pa.array(cut.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(off, pa.array(inner.astype(np.int32))),
                     pa.ListArray.from_arrays(off, pa.array(f))], names=["y", "s", "f"])

    return labelled.mapInArrow(run, "y int, s array<int>, f array<int>").toArrow()


def _documents(bags: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for b in bags.to_batches():
        off = b.column(1).offsets.to_numpy()
        s, f = b.column(1).values.to_numpy(), b.column(2).values.to_numpy()
        for y, lo, hi in zip(b.column(0).to_pylist(), off[:-1], off[1:]):
            if hi > lo:
                yield y, s[lo:hi], f[lo:hi]


def _likelihood_ratio(seen: np.ndarray, size: np.ndarray) -> np.ndarray:
    """G statistic of each feature's presence against the label."""
    table = np.stack([seen, size - seen])
    expected = table.sum(1, keepdims=True) * size[None] / size.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(table > 0, table * np.log(table / expected), 0.0)
    return 2 * part.sum((0, 1))


def fit_bags(bags: pa.Table, label_counts: dict[int, int], epochs: int = EPOCHS, decay: float = 2e-5, rate: float = 0.1) -> Model:
    """Noisy-or likelihood by full-batch Adam over the features linked to the label.

    Documents are weighted to the label counts of all labelled rows."""
    seen = np.zeros((2, DIMENSIONS), np.int32)
    size = np.zeros((2, 1))
    for label, _s, f in _documents(bags):
        seen[label, np.unique(f)] += 1
        size[label] += 1
    if not size.all():
        return Model(np.zeros(DIMENSIONS, np.float32), -30.0)
    used = np.flatnonzero(seen.sum(0) >= MIN_DOCS)
    # the more features are tried, the stronger a link must be to count
    used = used[_likelihood_ratio(seen[:, used].astype(float), size) >= 2 * np.log(max(2, len(used))) - 6]
    number = np.full(DIMENSIONS, -1, np.int32)
    number[used] = np.arange(len(used))
    labels, bag, sentence, feature, base = [], [], [], [], 0
    for label, s, f in _documents(bags):
        n = int(s.max()) + 1
        bag.append(np.full(n, len(labels), np.int32))
        labels.append(label)
        known = number[f] >= 0
        sentence.append(s[known].astype(np.int64) + base)
        feature.append(number[f[known]])
        base += n
    y, bag, sentence, f = np.array(labels), np.concatenate(bag), np.concatenate(sentence), np.concatenate(feature)
    w, b = np.zeros(len(used)), -5.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    weight = np.array([label_counts.get(k, 1) / size[k, 0] for k in (0, 1)])[y]
    for t in range(1, epochs + 1):
        z = np.bincount(sentence, weights=w[f], minlength=len(bag)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = np.bincount(bag, weights=np.logaddexp(0, z), minlength=len(y))  # -log prod(1 - p)
        miss = np.exp(-np.clip(total, 1e-9, 50))
        d_total = weight * np.where(y == 1, -miss / (1 - miss), 1.0) / weight.sum()
        d_z = d_total[bag] * p
        g = np.bincount(f, weights=d_z[sentence], minlength=len(used)) + decay * w
        gb = d_z.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = rate / (1 - 0.9 ** t) * np.sqrt(1 - 0.99 ** t)
        w -= step * m / (np.sqrt(v) + 1e-7)
        b -= step * mb / (vb ** 0.5 + 1e-7)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[used] = w
    return Model(weights, float(b))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_words: int = MAX_WORDS,
          learn: Column | None = None, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled rows (of those that ``learn`` allows)."""
    ids = F.col(id_col)
    lab = labels.select(ids.alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    if learn is not None:
        lab = lab.where(learn)
    counts = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    src = docs.select(ids.alias("doc_id"), F.col(text).cast("string").alias("text"))
    # lengths only, so that the places in the order go to texts that can be used
    sized = src.select("doc_id", F.length("text").alias("chars")).where(F.col("chars") > 0) \
        .join(lab, "doc_id").select("y", "doc_id", "chars")
    sized = staged(sized, "label-lengths")
    first = None
    for y in (0, 1):
        usable = sized.where((F.col("y") == y) & (F.col("chars") <= 6 * max_words // SHARE))
        one = usable.withColumn("at", order).orderBy("at", "doc_id").limit(max_docs)
        if y in counts and usable.isEmpty():
            one = sized.where(F.col("y") == y).withColumn("at", F.col("chars").cast("bigint")).orderBy("at", "doc_id").limit(max_docs)
        first = one if first is None else first.unionByName(one)
    # at most 2 * max_docs rows are left here; the running total (in characters,
    # six a word) ends the sample where the budget does
    so_far = F.sum("chars").over(Window.partitionBy("y").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("so_far") - F.col("chars")
    picked = first.withColumn("so_far", so_far).where((F.col("so_far") <= 6 * max_words) | (before == 0)) \
        .groupBy("y", "doc_id", "chars").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("y", "doc_id", "chars").orderBy(F.xxhash64("text")))
    rows = src.withColumn("chars", F.length("text")).join(F.broadcast(picked), ["doc_id", "chars"]) \
        .withColumn("nth", nth).where((F.col("nth") <= max_docs) & (F.col("nth") <= F.col("n"))).select("y", "text")
    bags = _bags(rows)
    if len(counts) == 2:
        found = {y for y, _s, _f in _documents(bags)}
        empty = [y for y in (0, 1) if y not in found]
        if empty and not src.isEmpty():
            raise ValueError(f"no text to learn from for label {empty}, which has {[counts[y] for y in empty]} labelled rows")
    return fit_bags(bags, counts)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", spans: bool = False,
          keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the ``keep`` columns), score and, if wanted, ``sentences``:
    the offending ones (first byte, end byte, score), best first.  A ``keep`` column
    may have any name but those of the two outputs."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias
    cols = keep or [id_col]
    body = unused("_text", cols)
    src = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text).cast("string").alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(weights.value, bias)
        for batch in batches:
            for b in pieces(batch, body, PIECE):
                s, z = _sentence_scores(m, b.column(len(cols)))
                total = np.bincount(s.row, weights=np.logaddexp(0, np.clip(z, -30, 30)), minlength=s.rows)
                p = np.where(np.diff(s.first) > 0, -np.expm1(-total), EMPTY_SCORE)
                out = [b.column(i) for i in range(len(cols))] + [pa.array(np.clip(p, 0.0, 1.0))]
                names = [*cols, "score"]
                if spans:
                    q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                    hit = np.flatnonzero(q >= THRESHOLD)
                    lists: list[list[dict]] = [[] for _ in range(s.rows)]
                    for k in hit:
                        o = int(s.offsets[s.row[k]])
                        lists[s.row[k]].append({"first": int(s.start[k]) - o, "end": int(s.end[k]) - o, "score": float(q[k])})
                    for x in lists:
                        x.sort(key=lambda d: -d["score"])
                    out.append(pa.array(lists, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
                    names.append("sentences")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", score double"
    return src.mapInArrow(run, schema + (", sentences array<struct<first:int,end:int,score:double>>" if spans else ""))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias, at = model.bias, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(weights.value, bias)
        for batch in batches:
            for b in pieces(batch, text, PIECE):
                s, z = _sentence_scores(m, b.column(at))
                total = np.bincount(s.row, weights=np.logaddexp(0, np.clip(z, -30, 30)), minlength=s.rows)
                yield b.filter(pa.array(-np.expm1(-total) < threshold))

    return docs.mapInArrow(run, docs.schema)
