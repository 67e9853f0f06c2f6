"""Exact duplicates by a 128-bit content hash, bytes compared inside groups.

Three passes of built-in expressions:

1. distinct (hash, normalised text) pairs.  Copies collapse inside each map task
   before the shuffle, so a group of any size sends at most one text per task; a
   hash left with more than one text is a collision and is noted (byte by byte:
   the texts themselves are the grouping key).
2. one narrow row per document (id, hash, length, digest, row number; the text
   only where its hash collides) is staged and grouped by (hash, text of a
   collision).  The survivor is the minimum of a small struct, aggregated before
   the shuffle.
3. documents look their group up.  Groups that hold more than a 1024th of all
   rows are at most 1,023 and are broadcast; the others are joined by hash, where
   no key is large.

Defined results: null text is the empty text, and empty texts are one group; a
null id comes after all others; among rows equal in id and length exactly one is
kept; an empty table gives no rows; only the named columns are read, and ``keep``
columns travel in a struct of their own, so their names may be any.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.llm.common import staged

BLANKS = " \t\n\x0b\x0c\r"
HOT_SHARE = 1024   # a group over 1/1024 of all rows is hot; there are fewer than 1024


def without_blanks(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]."""
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = without_blanks,
           hashed: Callable[[Column], Column] = content_hash, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and,
    if asked for, ``row``, a struct of the ``keep`` columns.

    Of texts that are equal after ``normalise``, the row with the most characters
    in its own text stays, then the smallest id.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc_id"), F.char_length(whole).alias("n_chars"), normalise(whole).alias("body"),
                      *([F.struct(*[F.col(c) for c in keep]).alias("row")] if keep else []))
    src = src.withColumn("hash", hashed(F.col("body")))
    clash = staged(src.select("hash", "body").distinct().groupBy("hash").agg(F.count("*").alias("bodies"))
                   .where("bodies > 1").select("hash", F.lit(True).alias("clash")), "exact-clash")
    rows = staged(src.join(clash, "hash", "left").select(
        "doc_id", "hash", F.when(F.col("clash"), F.col("body")).otherwise(F.lit("")).alias("rest"), "n_chars",
        F.unhex(F.sha2("body", 256)).alias("digest"), F.monotonically_increasing_id().alias("at"),
        *(["row"] if keep else [])), "exact-rows")
    first = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")
    classes = staged(rows.groupBy("hash", "rest").agg(F.count("*").alias("group_size"), F.min(first).alias("first")),
                     "exact-classes")
    hot = F.col("group_size") * HOT_SHARE > rows.count()
    few = F.broadcast(classes.where(hot))
    cold = rows.join(F.broadcast(classes.where(hot).select("hash", "rest")), ["hash", "rest"], "left_anti")
    both = rows.join(few, ["hash", "rest"]).unionByName(cold.join(classes.where(~hot), ["hash", "rest"]))
    return both.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
                       (F.col("at") == F.col("first.at")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
                       *(["row"] if keep else []))


def survivors(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The kept documents with all their columns."""
    return groups(docs, id_col, text, keep=docs.columns, **how).where("kept").select("row.*")
