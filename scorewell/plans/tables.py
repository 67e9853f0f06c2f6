"""Reading the driver tables (column pruning and filters reach the Parquet scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # the driver tables hold UTC wall-clock times; casts to timestamp must not shift them
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a UTC ``timestamp`` (watermarks reject ``timestamp_ntz``)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
