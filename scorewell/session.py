"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "scorewell",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session's configuration, so every call and every run of the
    application gives the same folder.  Only where it is unset, and the master
    is local (tests, bench), is a folder of our own made and registered once; a
    cluster without the setting is an error, since executors could not see it.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    d = spark.conf.get("scorewell.localSharedDir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="scorewell-shared-")
        spark.conf.set("scorewell.localSharedDir", d)
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    return os.path.join(checkpoint_dir(spark), *parts)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame once to the shared folder and return it re-read.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    later jobs all see the same rows.  All staged tables of an application lie in
    one folder, which ``clear_staged`` removes when its results are written.
    """
    spark = df.sparkSession
    path = os.path.join(staging_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staging_dir(spark: SparkSession) -> str:
    return shared_path(spark, f"scorewell-staged-{spark.sparkContext.applicationId}")


def clear_staged(spark: SparkSession) -> None:
    """Delete the application's staged tables; DataFrames that still read them are then invalid."""
    path = spark._jvm.org.apache.hadoop.fs.Path(staging_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
