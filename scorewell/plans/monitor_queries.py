"""Fixture queries: latest state, change events, staleness, windows and alerts over events.

A metric snapshot is derived from events: each event type stands for one
metric, ``value`` gives the metric value, ``user_id`` the feature label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.columns import map_values, r6, ts_micros
from scorewell.operators import latest as L
from scorewell.operators import models as MD
from scorewell.operators import monitor as MO
from scorewell.plans.tables import events, table

# Fixed values of the fixture.
NOW = "2024-02-01 00:00:00"
AS_OF = "2024-01-15 00:00:00"
METRIC_OF_TYPE = {"click": "drift_psi", "view": "drift_p_value", "purchase": "drift_verdict",
                  "error": "pipeline_status", "signup": "gate_verdict"}


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4-shaped snapshot rows ``(metric_name, value, labels, computed_at)`` from events."""
    ev = events(spark, sf_dir)
    name = map_values("event_type", METRIC_OF_TYPE)
    code = F.floor("value") % 3
    value = (F.when(name == "drift_psi", F.col("value") / 1000.0)
             .when(name == "drift_p_value", F.col("value") / 500.0)
             .when(name == "pipeline_status", code - 1)
             .otherwise(code))
    return ev.select(name.alias("metric_name"), value.cast("double").alias("value"),
                     F.create_map(F.lit("feature"), F.concat(F.lit("u"), F.col("user_id").cast("string")))
                     .alias("labels"), F.col("ts").alias("computed_at"))


def latest_state(spark, sf_dir):
    """K1: newest event per user (tie-break: event id)."""
    l = L.latest(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value", "ts"])
    return l.select("user_id", "event_id", "event_type", r6("value").alias("value"), ts_micros("ts").alias("ts_us"))


def as_of_state(spark, sf_dir):
    """K2: state of every user as of a fixed time."""
    l = L.as_of(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], AS_OF,
                ["event_id", "event_type", "value", "ts"])
    return l.select("user_id", "event_id", "event_type", r6("value").alias("value"), ts_micros("ts").alias("ts_us"))


def status_change(spark, sf_dir):
    """K8: events where a user's event type becomes ``purchase``."""
    c = L.becomes(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "event_type", "purchase")
    return c.select("user_id", "event_id", ts_micros("ts").alias("ts_us"))


def staleness(spark, sf_dir):
    """Seconds since the newest event of each type, at a fixed ``now``."""
    s = L.staleness(events(spark, sf_dir), ["event_type"], "ts", NOW)
    return s.select("event_type", r6("staleness_s").alias("staleness_s"))


def snapshot_gap(spark, sf_dir):
    """Largest gap between consecutive events of each type."""
    g = L.largest_gap(events(spark, sf_dir), ["event_type"], "ts", "event_id")
    return g.select("event_type", r6("max_gap_s").alias("max_gap_s"), "n")


def _status():
    return F.when(F.col("event_type") == "error", F.lit("5xx")).otherwise(F.lit("2xx"))


def request_rate(spark, sf_dir):
    """Requests per second per status over 5-minute windows sliding by 1 minute."""
    r = MO.request_rate(events(spark, sf_dir), "ts", _status())
    return r.select(ts_micros("window_start").alias("window_start_us"), "status", r6("rate").alias("rate"))


def error_rate(spark, sf_dir):
    """Error share in % per 5-minute window."""
    r = MO.error_rate(events(spark, sf_dir), "ts", F.col("event_type") == "error")
    return r.select(ts_micros("window_start").alias("window_start_us"), "requests", "errors",
                    r6("error_pct").alias("error_pct"))


def latency_quantile(spark, sf_dir):
    """p50 / p95 / p99 per window from latency histogram buckets."""
    q = MO.latency_quantiles(events(spark, sf_dir), "ts", "value")
    return q.select(ts_micros("window_start").alias("window_start_us"),
                    *[r6(c).alias(c) for c in ("p50", "p95", "p99")])


def dashboard_join(spark, sf_dir):
    """Latest PSI, p-value and verdict per feature; features missing one are dropped."""
    j = MO.latest_by_label(snapshot(spark, sf_dir), ["drift_psi", "drift_p_value", "drift_verdict"], "feature")
    return j.select("feature", *[r6(c).alias(c) for c in ("drift_psi", "drift_p_value", "drift_verdict")])


def verdict_counts(spark, sf_dir):
    """Number of features per latest drift verdict code."""
    return MO.verdict_counts(snapshot(spark, sf_dir), "drift_verdict", "feature")


def alerts(spark, sf_dir):
    """Rules over the latest series; status -1 (never ran) must not fire."""
    snap = snapshot(spark, sf_dir)
    l = MO.latest_series(snap, ["drift_verdict", "pipeline_status", "gate_verdict"], "feature")
    f = MO.firing(l, MO.alert_rules(spark), "feature")
    return f.select("rule", "feature", r6("value").alias("value"))


def latest_prediction_features(spark, sf_dir):
    """Newest event of the active "version" per user, joined to the customer row."""
    pred = events(spark, sf_dir).select(F.col("user_id").alias("c_custkey"), "event_id", F.col("value").alias("probability"),
                                        F.col("event_type").alias("model_version"), "ts")
    raw = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = MD.latest_with_features(pred, raw, "c_custkey", "purchase", ["ts", "event_id"])
    return j.select("c_custkey", "event_id", r6("probability").alias("probability"), r6("c_acctbal").alias("c_acctbal"), "c_mktsegment")


def time_range(spark, sf_dir):
    """K9: events of a fixed half-open range."""
    r = L.time_range(events(spark, sf_dir), "ts", AS_OF, NOW)
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


def as_of_join(spark, sf_dir):
    """K2 / J6, point in time: each purchase with its user's newest view at or before its hour."""
    ev = events(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    views = ev.where("event_type = 'view'").select("user_id", "hour", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    out = L.as_of_join(ev.where("event_type = 'purchase'").select("event_id", "user_id", "hour"), views, ["user_id"], "hour",
                       ["hour", "view_id"], ["view_id", "view_value"])
    return out.select("event_id", "view_id", r6("view_value").alias("view_value"))


QUERIES = {"as_of_join": as_of_join,"latest_prediction_features": latest_prediction_features, "time_range": time_range,
           
    "latest_state": latest_state, "as_of_state": as_of_state, "status_change": status_change,
    "staleness": staleness, "snapshot_gap": snapshot_gap, "request_rate": request_rate,
    "error_rate": error_rate, "latency_quantile": latency_quantile, "dashboard_join": dashboard_join,
    "verdict_counts": verdict_counts, "alerts": alerts,
}

_SNAP = """snap AS (
  SELECT CASE event_type WHEN 'click' THEN 'drift_psi' WHEN 'view' THEN 'drift_p_value' WHEN 'purchase' THEN 'drift_verdict'
              WHEN 'error' THEN 'pipeline_status' WHEN 'signup' THEN 'gate_verdict' END AS metric_name,
         CASE WHEN event_type = 'click' THEN value / 1000.0 WHEN event_type = 'view' THEN value / 500.0
              WHEN event_type = 'error' THEN CAST(CAST(floor(value) AS BIGINT) % 3 - 1 AS DOUBLE)
              ELSE CAST(CAST(floor(value) AS BIGINT) % 3 AS DOUBLE) END AS value,
         'u' || CAST(user_id AS VARCHAR) AS feature, ts AS computed_at
  FROM events
), lat AS (
  SELECT metric_name, feature, arg_max(value, (computed_at, value)) AS v FROM snap GROUP BY ALL
)"""

_WIN = """w AS (
  SELECT epoch_us(time_bucket(INTERVAL '1 minute', ts) - to_minutes(k)) AS window_start_us, *
  FROM events, range(0, 5) t(k)
)"""

ORACLE = {
    "as_of_join": """
WITH e AS (SELECT *, date_trunc('hour', ts) AS hour FROM events),
v AS (SELECT user_id, hour, event_id AS view_id, value AS view_value FROM e WHERE event_type = 'view'
      QUALIFY row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id DESC) = 1)
SELECT p.event_id, v.view_id, round(v.view_value, 6) AS view_value
FROM (SELECT * FROM e WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.hour >= v.hour""",
    "latest_prediction_features": """
WITH p AS (SELECT user_id AS c_custkey, max_by(event_id, (ts, event_id)) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT c_custkey, event_id, round(value, 6) AS probability, round(c_acctbal, 6) AS c_acctbal, c_mktsegment
FROM p JOIN events USING (event_id) JOIN customer USING (c_custkey)""",
    "time_range": """
SELECT event_type, count(*) AS n, min(event_id) AS first_id FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00' GROUP BY event_type""",
    "latest_state": """
SELECT user_id, r.event_id AS event_id, r.event_type AS event_type, round(r.value, 6) AS value, epoch_us(r.ts) AS ts_us
FROM (SELECT user_id, arg_max({'event_id': event_id, 'event_type': event_type, 'value': value, 'ts': ts}, (ts, event_id)) AS r
      FROM events GROUP BY user_id)""",
    "as_of_state": """
SELECT user_id, r.event_id AS event_id, r.event_type AS event_type, round(r.value, 6) AS value, epoch_us(r.ts) AS ts_us
FROM (SELECT user_id, arg_max({'event_id': event_id, 'event_type': event_type, 'value': value, 'ts': ts}, (ts, event_id)) AS r
      FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY user_id)""",
    "status_change": """
SELECT user_id, event_id, epoch_us(ts) AS ts_us FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
WHERE event_type = 'purchase' AND prev IS DISTINCT FROM 'purchase'""",
    "staleness": """
SELECT event_type, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - max(epoch_us(ts))) / 1e6, 6) AS staleness_s
FROM events GROUP BY event_type""",
    "snapshot_gap": """
SELECT event_type, round(max(gap), 6) AS max_gap_s, count(*) AS n FROM (
  SELECT event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1e6 AS gap
  FROM events) GROUP BY event_type""",
    "request_rate": f"""WITH {_WIN}
SELECT window_start_us, CASE WHEN event_type = 'error' THEN '5xx' ELSE '2xx' END AS status,
       round(count(*) / 300.0, 6) AS rate
FROM w GROUP BY ALL""",
    "error_rate": f"""WITH {_WIN}
SELECT window_start_us, count(*) AS requests, CAST(count_if(event_type = 'error') AS BIGINT) AS errors,
       round(100.0 * count_if(event_type = 'error') / count(*), 6) AS error_pct
FROM w GROUP BY window_start_us""",
    "latency_quantile": f"""WITH {_WIN},
bounds AS (SELECT [5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0, 10000.0, 'inf'::DOUBLE] AS b),
bi AS (SELECT window_start_us, len(list_filter(b, lambda x: x < value)) + 1 AS idx FROM w, bounds WHERE value IS NOT NULL),
cnt AS (SELECT window_start_us, idx, count(*) AS n FROM bi GROUP BY ALL),
cum AS (SELECT window_start_us, idx, n, sum(n) OVER (PARTITION BY window_start_us ORDER BY idx) AS c,
               sum(n) OVER (PARTITION BY window_start_us) AS tot FROM cnt),
qs AS (SELECT unnest([0.5::DOUBLE, 0.95::DOUBLE, 0.99::DOUBLE]) AS q),
pick AS (SELECT window_start_us, q, min(idx) FILTER (WHERE c >= q * tot) AS f, max(tot) AS tot FROM cum, qs GROUP BY ALL),
val AS (
  SELECT p.window_start_us, p.q,
         CASE WHEN p.f = 12 THEN b[11]
              WHEN p.f = 1 AND b[1] <= 0 THEN b[1]
              ELSE (CASE WHEN p.f > 1 THEN b[p.f - 1] ELSE 0.0 END)
                   + (b[p.f] - CASE WHEN p.f > 1 THEN b[p.f - 1] ELSE 0.0 END)
                     * ((p.q * p.tot - coalesce((SELECT max(c2.c) FROM cum c2 WHERE c2.window_start_us = p.window_start_us
                                                     AND c2.idx < p.f), 0)) / cur.n) END AS v
  FROM pick p, bounds JOIN cum cur ON cur.window_start_us = p.window_start_us AND cur.idx = p.f
)
SELECT window_start_us, round(max(v) FILTER (WHERE q = 0.5), 6) AS p50, round(max(v) FILTER (WHERE q = 0.95), 6) AS p95,
       round(max(v) FILTER (WHERE q = 0.99), 6) AS p99
FROM val GROUP BY window_start_us""",
    "dashboard_join": f"""WITH {_SNAP}
SELECT p.feature, round(p.v, 6) AS drift_psi, round(q.v, 6) AS drift_p_value, round(r.v, 6) AS drift_verdict
FROM lat p JOIN lat q ON p.feature = q.feature JOIN lat r ON p.feature = r.feature
WHERE p.metric_name = 'drift_psi' AND q.metric_name = 'drift_p_value' AND r.metric_name = 'drift_verdict'""",
    "verdict_counts": f"""WITH {_SNAP}
SELECT CAST(v AS INTEGER) AS code, count(*) AS n FROM lat WHERE metric_name = 'drift_verdict' GROUP BY ALL""",
    "alerts": f"""WITH {_SNAP}
SELECT CASE metric_name WHEN 'drift_verdict' THEN 'drift_stop' WHEN 'pipeline_status' THEN 'pipeline_failed'
            ELSE 'gate_stop' END AS rule, feature, round(v, 6) AS value
FROM lat
WHERE (metric_name = 'drift_verdict' AND v < 1) OR (metric_name = 'gate_verdict' AND v < 1)
   OR (metric_name = 'pipeline_status' AND v >= -0.5 AND v <= 0.5)""",
}
