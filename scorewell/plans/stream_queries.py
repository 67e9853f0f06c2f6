"""Fixture queries that run the streaming jobs over ``events`` as a stream (availableNow).

Each query starts the streaming job, waits for it to drain the source and
returns the sink it wrote: its final state equals the batch semantics, which
the oracle SQL computes directly.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.columns import r6, ts_micros
from scorewell.operators import monitor as MO
from scorewell.operators import validate as V
from scorewell.plans.monitor_queries import ORACLE as MONITOR_SQL
from scorewell.plans.tables import table
from scorewell.session import shared_path
from scorewell.streaming import jobs as J

# Fixed values of the fixture: the request contract and the linear scorer.
EVENT_CONTRACT = V.Contract(numeric={"value": V.Range(0, 300)},
                            categories={"event_type": ["click", "view", "purchase", "signup"]})


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(sf_dir, "events.parquet")
    schema = table(spark, sf_dir, "events").schema
    return J.file_stream(spark, path, schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _score_col():
    return 1.0 / (1.0 + F.exp(-(F.col("value") / 100.0 - 1.0)))


def _run_scoring(spark, sf_dir) -> str:
    out = shared_path(spark, "scorewell-stream-out", os.urandom(8).hex())
    J.score_stream(_event_stream(spark, sf_dir), EVENT_CONTRACT, _score_col(), ["event_id"], out, "score_events")
    return out


def score_stream(spark, sf_dir):
    """Valid events scored by the streaming job."""
    out = _run_scoring(spark, sf_dir)
    return spark.read.parquet(os.path.join(out, "scored")).select("event_id", r6("score").alias("score"))


def dead_letter(spark, sf_dir):
    """Rejected events with their first rule as code; they never reach the scorer."""
    out = _run_scoring(spark, sf_dir)
    return spark.read.parquet(os.path.join(out, "dead_letter")).select("event_id", "code")


def alert_repeat(spark, sf_dir):
    """Error events fire ``pipeline_failed`` per user; repeats within 1 hour are suppressed."""
    s = _event_stream(spark, sf_dir).where(F.col("event_type") == "error")
    n = J.notify_with_repeat(s.withColumn("rule", F.lit("pipeline_failed")), "rule", "user_id", "ts",
                             F.lit("pipeline"))
    out = shared_path(spark, "scorewell-stream-out", os.urandom(8).hex())

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
    J.run_available_now(n, "alert_repeat", out, sink)
    r = spark.read.parquet(out)
    return r.select("rule", F.col("series").cast("bigint").alias("user_id"), "ts_us")


def request_windows_stream(spark, sf_dir):
    """T1-T3 as a watermarked stream of panes (update mode), windows finished from their final state."""
    s = _event_stream(spark, sf_dir)
    w = J.request_panes(s, "ts", F.col("event_type") == "error", "value")
    out = shared_path(spark, "scorewell-stream-out", os.urandom(8).hex())

    def sink(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(os.path.join(out, f"b={batch_id}"))
    J.run_available_now(w, "windows", out, sink, mode="update")
    got = MO.request_windows(J.newest_panes(spark.read.parquet(out).drop("b")))
    return got.select(ts_micros("window_start").alias("window_start_us"), "requests", "errors", r6("rate").alias("rate"),
                      r6("error_pct").alias("error_pct"), *[r6(c).alias(c) for c in ("p50", "p95", "p99")])


# Fixed values of the fixture: delivery of the run log, in files that arrive one after another.
ARRIVALS, DELAY_HOURS, TTL_DAYS = 6, 12, 2
FILE_ROWS = 1_000_000


def _late_log(spark, sf_dir) -> tuple[str, int]:
    """Events as a run log of ``ARRIVALS`` deliveries, each row up to ``DELAY_HOURS`` late;
    the folder and the files of a delivery (about ``FILE_ROWS`` rows each)."""
    ev = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(DELAY_HOURS * 3600 - 60)) * 1_000_000
    ev = ev.withColumn("_come", F.unix_micros("ts") + late)
    r = ev.agg(F.min("_come").alias("a"), F.max("_come").alias("b"), F.count(F.lit(1)).alias("n")).first()
    files = max(1, -(-r["n"] // (ARRIVALS * FILE_ROWS)))
    path = shared_path(spark, "scorewell-stream-in", os.urandom(8).hex())
    part = F.least(F.lit(ARRIVALS - 1), F.floor((F.col("_come") - r["a"]) * ARRIVALS / max(1, r["b"] - r["a"])))
    for k in range(ARRIVALS):  # in turn, so the files' times follow the order of arrival
        rows = ev.where(part == k).drop("_come")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(path)
    return path, files


def completed_runs(spark, sf_dir):
    """A run log from ``events`` (a user is a generation, a purchase completes it) that
    arrives in six micro-batches with late rows: the times at which each becomes
    completed, and the number of rows scored for it."""
    path, files = _late_log(spark, sf_dir)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)
    log = stream.withColumn("status", F.when(F.col("event_type") == "purchase", "completed").otherwise("running"))
    out = shared_path(spark, "scorewell-stream-out", os.urandom(8).hex())
    events = table(spark, sf_dir, "events")

    def handle(batch, batch_id):
        batch = batch.withColumn("user_id", F.col("generation_id").cast("bigint")).persist()
        rows = events.join(batch.select("user_id").distinct(), "user_id", "left_semi")
        scored = rows.select("user_id", _score_col().alias("score")).groupBy("user_id").agg(F.count("*").alias("n_scored"))
        batch.join(scored, "user_id").select("user_id", "completed_us", "n_scored").write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
        batch.unpersist()
    runs = J.completed_runs(log, "user_id", "status", "ts", "event_id", f"{DELAY_HOURS} hours", dt.timedelta(days=TTL_DAYS))
    J.score_completed_runs(runs, "completed_runs", out, handle)
    return spark.read.parquet(out).select("user_id", "completed_us", "n_scored")


QUERIES = {"completed_runs": completed_runs, "score_stream": score_stream, "dead_letter": dead_letter, "alert_repeat": alert_repeat,
           "request_windows_stream": request_windows_stream}

ORACLE = {
    # rows that the last watermark has not passed are still held
    "completed_runs": """
WITH e AS (SELECT *, epoch_us(ts) AS us FROM events),
w AS (SELECT max(us) // 1000 * 1000 - 43200000000 AS wm FROM e),
l AS (SELECT user_id, us, event_type = 'purchase' AS done, lag(event_type = 'purchase') OVER o AS before, us - lag(us) OVER o AS gap
      FROM e, w WHERE us < wm WINDOW o AS (PARTITION BY user_id ORDER BY us, event_id)),
n AS (SELECT user_id, count(*) AS n_scored FROM events GROUP BY user_id)
SELECT user_id, us AS completed_us, n_scored FROM l JOIN n USING (user_id)
WHERE done AND NOT (coalesce(before, false) AND coalesce(gap <= 172800000000, false))""",
    "score_stream": """
SELECT event_id, round(1.0 / (1.0 + exp(-(value / 100.0 - 1.0))), 6) AS score FROM events
WHERE value IS NOT NULL AND NOT isnan(value) AND value BETWEEN 0 AND 300
  AND event_type IS NOT NULL AND event_type IN ('click', 'view', 'purchase', 'signup')""",
    "dead_letter": """
SELECT event_id, CASE WHEN value IS NULL OR event_type IS NULL THEN 'not_null'
                      WHEN isnan(value) THEN 'type'
                      WHEN value < 0 OR value > 300 THEN 'range' ELSE 'domain' END AS code
FROM events
WHERE NOT (value IS NOT NULL AND NOT isnan(value) AND value BETWEEN 0 AND 300
           AND event_type IS NOT NULL AND event_type IN ('click', 'view', 'purchase', 'signup'))""",
    "alert_repeat": """
WITH RECURSIVE f AS (SELECT user_id AS k, epoch_us(ts) AS t FROM events WHERE event_type = 'error'),
chain(k, t) AS (
  SELECT k, min(t) FROM f GROUP BY k
  UNION ALL
  SELECT c.k, (SELECT min(f.t) FROM f WHERE f.k = c.k AND f.t >= c.t + 3600000000) FROM chain c WHERE c.t IS NOT NULL
)
SELECT 'pipeline_failed' AS rule, k AS user_id, t AS ts_us FROM chain WHERE t IS NOT NULL""",
    "request_windows_stream": f"""
WITH w AS (
  SELECT epoch_us(time_bucket(INTERVAL '1 minute', ts) - to_minutes(k)) AS window_start_us, *
  FROM events, range(0, 5) t(k)
), q AS ({MONITOR_SQL["latency_quantile"]}),
g AS (SELECT window_start_us, count(*) AS requests, CAST(count_if(event_type = 'error') AS BIGINT) AS errors,
             round(count(*) / 300.0, 6) AS rate, round(100.0 * count_if(event_type = 'error') / count(*), 6) AS error_pct
      FROM w GROUP BY window_start_us)
SELECT g.*, p50, p95, p99 FROM g LEFT JOIN q USING (window_start_us)""",
}
