"""Shared helpers: tables, intermediate results in the shared folder, free column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from scorewell.session import staged

__all__ = ["read", "shuffle_partitions", "staged", "unused"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(prefix: str, taken: Iterable[str]) -> str:
    """``prefix`` with as many underscores before it as no taken name begins with it."""
    taken = [t.lower() for t in taken]
    while any(t.startswith(prefix.lower()) for t in taken):
        prefix = "_" + prefix
    return prefix


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
