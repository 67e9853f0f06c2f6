"""How filters interact: every order of every filter, from wide packed counters.

Each document fails a set of filters, its mask.  What a mask means for the
filters in any order is fixed: a step keeps it, removes it, or finds it gone
already.  So each mask is one big integer with a 64-bit field for every outcome
of every step of every order (for five filters 600 steps: kept, removed,
redundant, unique).  Adding the integers of all documents of a part adds all
fields at once; a field never exceeds the number of documents, a bigint, so no
field carries into the next.  Documents with equal masks are counted first, so
a part, however large, adds at most ``2 ** filters`` integers per label.

The duplicates filter compares texts by SHA-256 over the whole table and needs
no join of rows: copies share their other outcomes, so per text and label it is
enough to know how many rows there are and how many carry the smallest id.

Defined results: null text is the empty text, null part the empty string; a null
id is larger than every id and two null ids do not fail for each other; rows with
the same id and text do not fail for each other; a document labelled more than
once has a mark if any of its labels says so; labels without a document are
ignored; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.llm.common import staged

LETTERS = "ABCDE"
FIELDS = ("kept", "removed", "redundant", "unique_fails")
_BITS = 64
_BLANK = r"[\x20\x09-\x0D]+"


def orders(letters: str = LETTERS) -> list[str]:
    return ["".join(p) for p in itertools.permutations(letters)]


def packed(letters: str = LETTERS) -> list[int]:
    """The big integer of each mask; bit k of a mask: the k-th letter's filter fails.

    Fields are ordered (kind, order, step), kinds as in ``FIELDS``.
    """
    steps = [(o, k) for o in orders(letters) for k in range(len(letters))]
    bit = {c: 1 << i for i, c in enumerate(letters)}
    out = []
    for mask in range(1 << len(letters)):
        total = 0
        for at, (order, k) in enumerate(steps):
            here, gone = mask & bit[order[k]], any(mask & bit[c] for c in order[:k])
            for kind, holds in enumerate((not here and not gone, here and not gone, here and gone, mask == bit[order[k]])):
                if holds:
                    total |= 1 << _BITS * (kind * len(steps) + at)
        out.append(total)
    return out


def unpack(total: int, letters: str = LETTERS) -> np.ndarray:
    """Fields of a sum of packed integers, shaped (kinds, orders, steps)."""
    shape = (len(FIELDS), len(orders(letters)), len(letters))
    return np.frombuffer(total.to_bytes(int(np.prod(shape)) * _BITS // 8, "little"), "<i8").reshape(shape)


def audit(counts: DataFrame, letters: str = LETTERS, marks: Sequence[str] = ("good", "toxic")) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails,
    ``<mark>_lost`` ..., shapley) from (part, mask, marks..., n).

    ``shapley`` is what a step's filter removes, summed over all orders.
    """
    names, marks = orders(letters), list(marks)
    table = packed(letters)  # a constant of the letters: 32 integers of 19 kB for five

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        whole, lost = 0, [0] * len(marks)
        held = [rows[m].tolist() for m in marks]
        for i, (mask, n) in enumerate(zip(rows["mask"].tolist(), rows["n"].tolist())):
            whole += table[mask] * n
            for k in range(len(marks)):
                if held[k][i]:
                    lost[k] += table[mask] * n
        kept, removed, redundant, unique = unpack(whole, letters)
        by_letter = {c: 0 for c in letters}
        for o, line in zip(names, removed):
            for c, v in zip(o, line):
                by_letter[c] += int(v)
        out = {"part": rows["part"].iloc[0], "filter_order": np.repeat(names, len(letters)),
               "step": np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(names)),
               "kept": kept.ravel(), "removed": removed.ravel(), "redundant": redundant.ravel(), "unique_fails": unique.ravel()}
        for m, total in zip(marks, lost):
            out[f"{m}_lost"] = unpack(total, letters)[FIELDS.index("removed")].ravel()
        out["shapley"] = [by_letter[c] for o in names for c in o]
        return pd.DataFrame(out)

    schema = "part string, filter_order string, step int, " + ", ".join(
        f"{c} bigint" for c in (*FIELDS, *(f"{m}_lost" for m in marks), "shapley"))
    return counts.groupBy("part").applyInPandas(run, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D of a text that is not null."""
    words = F.array_remove(F.split(text, _BLANK), "")
    n = F.size(words)
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.char_length(text), "D": text.rlike("[#$%&*|]")}


def document_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                   part: str = "source") -> DataFrame:
    """(part, mask, good, toxic, n) of documents under the filters A to E."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(text_failures(F.col("body")).values())), F.lit(0))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), body.alias("body"))
    rows = staged(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("body", 256)).alias("digest")), "audit-rows")
    mark = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.groupBy("doc_id").agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    no = F.lit(False)
    marked = rows.where("doc_id is not null").join(known, "doc_id", "left") \
        .withColumn("good", F.coalesce("good", no)).withColumn("toxic", F.coalesce("toxic", no)) \
        .unionByName(rows.where("doc_id is null").withColumn("good", no).withColumn("toxic", no))
    same = ["digest", "part", "mask", "good", "toxic"]
    by_id = marked.groupBy(*same, "doc_id").agg(F.count("*").alias("n"))
    per_text = by_id.groupBy(*same).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("n_low"))
    lowest = F.min("low").over(Window.partitionBy("digest"))  # rows of a digest: its parts and labels only
    passing = F.when(F.col("lowest").isNull(), F.col("n")).when(F.col("low") == F.col("lowest"), F.col("n_low")).otherwise(F.lit(0))
    split = per_text.withColumn("lowest", lowest).withColumn("pass", passing.cast("bigint"))
    both = F.explode(F.array(F.struct("mask", F.col("pass").alias("n")),
                             F.struct((F.col("mask") + (1 << LETTERS.index("E"))).alias("mask"), (F.col("n") - F.col("pass")).alias("n"))))
    return split.select("part", "good", "toxic", both.alias("x")).where("x.n > 0") \
        .groupBy("part", F.col("x.mask").alias("mask"), "good", "toxic").agg(F.sum("x.n").alias("n"))


def audit_documents(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """The audit of filters A to E over documents, per part."""
    return audit(document_masks(docs, labels, **names))
