"""Scans and sinks.

Scans are plain DataFrame reads: Catalyst prunes the columns and pushes the
filters into the Parquet reader; partitioned layouts prune whole directories.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def projected_scan(spark: SparkSession, path: str, id_col: str, columns: Sequence[str],
                   limit: int | None = None) -> DataFrame:
    """Id + the given columns ordered by id; a limit applies after ordering (top-k)."""
    df = spark.read.parquet(path).select(id_col, *columns)
    return df.orderBy(id_col).limit(limit) if limit else df


def batch_key_scan(spark: SparkSession, path: str, key_col: str, key, columns: Sequence[str] | None = None,
                   limit: int | None = None, id_col: str | None = None) -> DataFrame:
    """Rows of one batch key (``generation_id``); the key must be given."""
    if key is None:
        raise ValueError(f"{key_col} is required for this source")
    df = spark.read.parquet(path).where(F.col(key_col) == F.lit(key))
    if columns:
        df = df.select(*([id_col] if id_col else []), *columns)
    if limit:
        df = df.orderBy(id_col or key_col).limit(limit)
    return df


def membership_scan(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``ids`` (a semi join; no duplicates from the id side)."""
    return df.join(ids.select(key), key, "left_semi")


def filtered_predictions(spark: SparkSession, path: str, source_table: str) -> DataFrame:
    """Stored predictions of one source (partition pruning on ``source_table``)."""
    return spark.read.parquet(path).where(F.col("source_table") == source_table)


def csv_scan(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_splits(df: DataFrame, path: str, features: Sequence[str], label: str, seed: int,
                 split_col: str = "split") -> DataFrame:
    """Features + label per split (partitioned) and a one-row metadata table.

    Returns the metadata row (feature names, imbalance ratio, seed) that was written.
    """
    df.select(split_col, *features, label).write.mode("overwrite").partitionBy(split_col).parquet(f"{path}/data")
    r = df.where(F.col(split_col) == "train").agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("p"), F.sum((F.col(label) != 1).cast("bigint")).alias("n")).first()
    ratio = (r["n"] / r["p"]) if r["p"] else None
    spark = df.sparkSession
    meta = spark.createDataFrame([(json.dumps(list(features)), ratio, seed)],
                                 "feature_names string, imbalance_ratio double, seed int")
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
    return meta


def write_summary(df: DataFrame, path: str, fmt: str = "json") -> None:
    """An aggregated result as one CSV or JSON file set."""
    w = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)
