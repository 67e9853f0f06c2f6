"""Corpus pipeline: documents become packed training sequences.

Each stage takes what the one before kept: toxic documents go, then documents
that the quality rules reject, then all but one document of each near-duplicate
group, then repeated passages, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm import minhash_bayes, packing, quality_sketch, substring_dedup, toxicity
from scorewell.llm.common import read, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels
    of these documents, the held-out quarter of ids excepted."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~toxicity.held_out(F.col("doc_id")))
    return toxicity.keep_clean(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rules and the fences of their language and source."""
    return quality_sketch.keep_sound(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest id) of each component on 5-word shingles at 0.8."""
    return minhash_bayes.keep_first(docs, width=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows of 35 words that occur twice."""
    return substring_dedup.remove_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents placed in sequences of 1024 tokens."""
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality), ("near_duplicates", drop_near_duplicates),
          ("substring_dedup", drop_repeated_passages), ("packing", pack_sequences)]

#: no stage but the first could be written in SQL over whole texts
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is staged."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
