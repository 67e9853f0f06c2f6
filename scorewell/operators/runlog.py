"""Committed runs: tables that many runs append to.

A run is written aside, into a folder of its own attempt, and published by one small
append to a manifest that every reader consults.  A run that fails or is killed
before that is invisible, whatever it left behind; runs do not wait for each other;
a retry of a run id replaces it for readers from the moment it is published.

``RunState`` keeps small mergeable aggregates (counts, sums, newest times) per run
beside the rows, so questions about all runs read a few rows a run.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "run_id string, attempt string, n_rows bigint, seq bigint"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The attempt that counts for each published run (the newest one)."""
    try:
        log = spark.read.schema(MANIFEST_SCHEMA).parquet(os.path.join(root, "manifest"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], MANIFEST_SCHEMA)
    return log.groupBy("run_id").agg(F.max_by(F.struct("attempt", "n_rows", "seq"), F.struct("seq", "attempt")).alias("x")).select("run_id", "x.*")


def write_aside(df: DataFrame, root: str, table: str, attempt: str) -> int:
    """Write a run's rows where no reader looks yet; returns their number."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(os.path.join(root, table, f"attempt={attempt}"))
    return seen.get["n"]


def publish(spark: SparkSession, root: str, run_id: str, attempt: str, n_rows: int) -> None:
    """Make a written attempt the run's rows: one append of one row."""
    spark.createDataFrame([(run_id, attempt, n_rows, time.time_ns())], MANIFEST_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(os.path.join(root, "manifest"))


def append_run(df: DataFrame, root: str, run_id: str | None = None, table: str = "rows") -> str:
    """Append a run and return its id."""
    run_id, attempt = run_id or str(uuid.uuid4()), uuid.uuid4().hex
    publish(df.sparkSession, root, run_id, attempt, write_aside(df, root, table, attempt))
    return run_id


def read_runs(spark: SparkSession, root: str, table: str = "rows", run_ids: Sequence[str] | None = None) -> DataFrame:
    """Rows of published runs, with ``run_id``; attempts are partitions, so others are not read."""
    runs = manifest(spark, root)
    if run_ids is not None:
        runs = runs.where(F.col("run_id").isin(list(run_ids)))
    return spark.read.parquet(os.path.join(root, table)).join(runs.select("run_id", "attempt"), "attempt").drop("attempt")


class RunState:
    """Aggregates of a run per key: ``n``, sums of columns, newest of times."""

    def __init__(self, keys: Sequence[str], sums: Sequence[str] = (), newest: Sequence[str] = ()):
        self.keys, self.sums, self.newest = list(keys), list(sums), list(newest)

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in self.sums],
            *[F.count(c).alias(f"n_{c}") for c in self.sums], *[F.max(c).alias(f"max_{c}") for c in self.newest])

    def append(self, df: DataFrame, root: str, run_id: str | None = None) -> str:
        """Append a run's rows and their state under one publication."""
        spark, run_id, attempt = df.sparkSession, run_id or str(uuid.uuid4()), uuid.uuid4().hex
        n = write_aside(df, root, "rows", attempt)
        written = spark.read.schema(df.schema).parquet(os.path.join(root, "rows", f"attempt={attempt}"))
        self.of(written).coalesce(1).write.parquet(os.path.join(root, "state", f"attempt={attempt}"))
        publish(spark, root, run_id, attempt, n)
        return run_id

    def merged(self, spark: SparkSession, root: str) -> DataFrame:
        """The state of all published runs: equal to ``of`` all their rows."""
        return read_runs(spark, root, "state").groupBy(*self.keys).agg(
            F.sum("n").alias("n"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in self.sums],
            *[F.sum(f"n_{c}").alias(f"n_{c}") for c in self.sums], *[F.max(f"max_{c}").alias(f"max_{c}") for c in self.newest])


#: state of the predictions: A6 (count and mean probability per version) and A7 (newest time)
PREDICTIONS = RunState(["source_table", "model_version"], ["probability"], ["predicted_at"])


def per_version(spark: SparkSession, root: str) -> DataFrame:
    """A6 from the state."""
    g = PREDICTIONS.merged(spark, root).groupBy("model_version").agg(
        F.sum("n").alias("n"), F.sum("sum_probability").alias("s"), F.sum("n_probability").alias("k"))
    return g.select("model_version", "n", F.try_divide("s", F.col("k").cast("double")).alias("mean_probability"))


def staleness(spark: SparkSession, root: str, now) -> DataFrame:
    """A7 from the state: seconds since each source's newest prediction."""
    g = PREDICTIONS.merged(spark, root).groupBy("source_table").agg(F.max("max_predicted_at").alias("at"))
    return g.select("source_table", ((F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col("at").cast("timestamp"))) / 1e6).alias("staleness_s"))
