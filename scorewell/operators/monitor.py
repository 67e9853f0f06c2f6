"""Monitoring over metric snapshots and request streams.

Snapshot rows are ``(metric_name, value, labels map<string,string>, computed_at)``.
The window metrics take a batch or a streaming DataFrame alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.functions.columns import run_status_code, verdict_code

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("computed_at", T.TimestampType()),
])

# Latency histogram bucket upper bounds (ms); the last is +Inf.
LATENCY_BUCKETS_MS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0, 10000.0,
                      float("inf")]


def latest_by_label(snap: DataFrame, metrics: Sequence[str], label: str) -> DataFrame:
    """One row per label value with the newest value of each metric, from ONE aggregate.

    Replaces a three-way join of latest-per-key sets (one shuffle instead of
    three); a label value that misses any metric is dropped, as the inner join did.
    """
    s = snap.where(F.col("metric_name").isin(list(metrics))).withColumn("_l", F.col("labels")[label])
    order = F.struct("computed_at", "value")
    g = s.where(F.col("_l").isNotNull()).groupBy(F.col("_l").alias(label)).agg(
        *[F.max_by(F.when(F.col("metric_name") == m, F.col("value")),
                   F.when(F.col("metric_name") == m, order)).alias(m) for m in metrics])
    cond = F.lit(True)
    for m in metrics:
        cond = cond & F.col(m).isNotNull()
    return g.where(cond)


def latest_series(snap: DataFrame, metrics: Sequence[str], label: str) -> DataFrame:
    """T5 / K4: newest value per (metric, label value)."""
    s = snap.where(F.col("metric_name").isin(list(metrics))).withColumn("_l", F.col("labels")[label])
    return (s.groupBy("metric_name", F.col("_l").alias(label))
            .agg(F.max_by("value", F.struct("computed_at", "value")).alias("value"),
                 F.max("computed_at").alias("computed_at")))


def verdict_counts(snap: DataFrame, metric: str, label: str) -> DataFrame:
    """How many label values have each latest verdict code."""
    l = latest_series(snap, [metric], label)
    return l.groupBy(F.col("value").cast("int").alias("code")).agg(F.count(F.lit(1)).alias("n"))


def alert_rules(spark: SparkSession) -> DataFrame:
    """T6 rules (fixed values): drift verdict < 1; pipeline status in [-.5, .5]; gate verdict < 1."""
    rows = [("drift_stop", "drift_verdict", None, 1.0),
            ("pipeline_failed", "pipeline_status", -0.5, 0.5),
            ("gate_stop", "gate_verdict", None, 1.0)]
    return spark.createDataFrame(rows, "rule string, metric_name string, lo double, hi double")


def firing(latest_values: DataFrame, rules: DataFrame, label: str) -> DataFrame:
    """Rule x latest series; ``hi`` alone means ``value < hi``; ``lo`` and ``hi`` mean a
    closed range.  No data -> no row (OK).  The rules table has a fixed handful of rows."""
    j = latest_values.join(F.broadcast(rules), "metric_name")
    fire = F.when(F.col("lo").isNull(), F.col("value") < F.col("hi")).otherwise(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    return j.where(fire).select("rule", label, "value")


# ---------------------------------------------------------------- request windows
def status_class(c: Column) -> Column:
    return F.concat(F.substring(c.cast("string"), 1, 1), F.lit("xx"))


PANE = "1 minute"
PANE_SECONDS = 60


def panes(df: DataFrame, time_col: str, keys: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """Partial sums per one-minute pane (``pane``) and key; every row is counted once.

    Works on a stream as well: the state holds panes, not windows."""
    g = df.groupBy(F.window(time_col, PANE).alias("_w"), *[c.alias(k) for k, c in keys.items()])
    return g.agg(*[F.sum(c).alias(n) for n, c in sums.items()]).select(F.col("_w.start").alias("pane"), *keys, *sums)


def sliding(panes_: DataFrame, keys: Sequence[str], sums: Sequence[str], minutes: int = 5) -> DataFrame:
    """Windows of ``minutes`` panes sliding by one: each pane, not each row, goes to
    every window that holds it."""
    back = F.explode(F.sequence(F.lit(0), F.lit(minutes - 1))).alias("_k")
    start = F.timestamp_micros(F.unix_micros("pane") - F.col("_k") * (PANE_SECONDS * 1_000_000))
    return panes_.select("*", back).groupBy(start.alias("window_start"), *keys).agg(*[F.sum(c).alias(c) for c in sums])


def request_rate(df: DataFrame, time_col: str, status: Column, minutes: int = 5) -> DataFrame:
    """Requests per second per status over sliding windows."""
    w = sliding(panes(df, time_col, {"status": status}, {"n": F.lit(1)}), ["status"], ["n"], minutes)
    return w.select("window_start", "status", (F.col("n") / float(PANE_SECONDS * minutes)).alias("rate"))


def error_rate(df: DataFrame, time_col: str, is_error: Column, minutes: int = 5) -> DataFrame:
    """Error share in % per window; no requests -> null."""
    w = sliding(panes(df, time_col, {}, {"requests": F.lit(1), "errors": is_error.cast("bigint")}), [], ["requests", "errors"], minutes)
    return w.select("window_start", "requests", "errors", error_pct())


def error_pct() -> Column:
    return F.when(F.col("requests") > 0, 100.0 * F.col("errors") / F.col("requests")).alias("error_pct")


def bucket_sums(latency: str, bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> dict[str, Column]:
    """The count of each latency bucket (``value <= bound``, first matching bucket) as sums."""
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    idx = F.when(F.col(latency).isNotNull(), F.size(F.filter(arr, lambda b: b < F.col(latency))))
    return {f"b{i}": F.coalesce((idx == i).cast("bigint"), F.lit(0).cast("bigint")) for i in range(len(bounds))}


def latency_histogram(df: DataFrame, time_col: str, latency: str, bounds: Sequence[float] = LATENCY_BUCKETS_MS,
                      minutes: int = 5) -> DataFrame:
    """Per window: the count of each bucket."""
    sums = bucket_sums(latency, bounds)
    w = sliding(panes(df.where(F.col(latency).isNotNull()), time_col, {}, sums), [], list(sums), minutes)
    return w.select("window_start", F.array(*[F.col(c) for c in sums]).alias("counts"))


def request_windows(panes_: DataFrame, minutes: int = 5, qs=(0.5, 0.95, 0.99), bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> DataFrame:
    """T1-T3 from panes of requests, errors and buckets, of a batch or as a stream left
    them: requests, errors, rate, error share and latency quantiles per window."""
    b = [f"b{i}" for i in range(len(bounds))]
    w = sliding(panes_, [], ["requests", "errors", *b], minutes).withColumn("counts", F.array(*[F.col(c) for c in b])) \
        .withColumn("_cum", cumulative(F.col("counts")))
    return w.select("window_start", "requests", "errors", (F.col("requests") / float(PANE_SECONDS * minutes)).alias("rate"), error_pct(),
                    *[histogram_quantile(q, F.col("counts"), F.col("_cum"), bounds).alias(f"p{int(q * 100)}") for q in qs])


def cumulative(counts: Column) -> Column:
    """Running sums of an array of counts."""
    k = F.size(counts)
    return F.transform(F.sequence(F.lit(1), k),
                       lambda i: F.aggregate(F.slice(counts, 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x))


def histogram_quantile(q: float, counts: Column, cum: Column, bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> Column:
    """Quantile from bucket counts (and their running sums ``cum``), linear inside the
    bucket; the +Inf bucket returns its lower bound; the first bucket starts at 0; no
    observations -> null."""
    k = len(bounds)
    b = F.array(*[F.lit(float(x)) for x in bounds])
    total = F.element_at(cum, k)
    rank = F.lit(float(q)) * total
    first = F.array_position(F.transform(cum, lambda c: c >= rank), F.lit(True)).cast("int")
    prev_cum = F.when(first > 1, F.element_at(cum, F.greatest(first - 1, F.lit(1)))).otherwise(F.lit(0))
    start = F.when(first > 1, F.element_at(b, F.greatest(first - 1, F.lit(1)))).otherwise(F.lit(0.0))
    end = F.element_at(b, F.greatest(first, F.lit(1)))
    n_in = F.element_at(counts, F.greatest(first, F.lit(1)))
    val = start + (end - start) * F.try_divide(rank - prev_cum, n_in.cast("double"))
    return (F.when(total.isNull() | (total == 0), F.lit(None).cast("double"))
            .when(first == k, F.element_at(b, k - 1))
            .when((first == 1) & (end <= 0), end)
            .otherwise(val))


def latency_quantiles(df: DataFrame, time_col: str, latency: str, qs=(0.5, 0.95, 0.99),
                      bounds: Sequence[float] = LATENCY_BUCKETS_MS) -> DataFrame:
    h = latency_histogram(df, time_col, latency, bounds).withColumn("_cum", cumulative(F.col("counts")))
    return h.select("window_start", *[histogram_quantile(q, F.col("counts"), F.col("_cum"), bounds)
                                      .alias(f"p{int(q * 100)}") for q in qs])


def metric_samples(df: DataFrame, name: str, value: Column, labels: dict[str, Column],
                   at: Column) -> DataFrame:
    """T4: one spec's result as snapshot rows ``(metric_name, value, labels, computed_at)``."""
    lab = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), v.cast("string"))]) if labels \
        else F.create_map().cast("map<string,string>")
    return df.select(F.lit(name).alias("metric_name"), value.cast("double").alias("value"),
                     lab.alias("labels"), at.cast("timestamp").alias("computed_at"))


def metric_specs(tables: dict[str, DataFrame], now: Column) -> dict:
    """T4: the twelve named metrics as functions that give snapshot rows.

    ``tables``: requests (at, status, is_error, latency_ms), flow_runs (flow_name,
    status, duration_s, ended_at), gate_runs (source_table, verdict, run_at),
    predictions (source_table, predicted_at), drift (feature_name, psi, p_value,
    verdict, computed_at).  Request metrics cover the five minutes before ``now``;
    the others are each label's newest value.  Nothing runs until a function is
    called, so a missing or broken table fails its own specs only.
    """
    def recent() -> DataFrame:
        r = tables["requests"]
        return r.where((F.col("at") > now - F.expr("INTERVAL 5 MINUTES")) & (F.col("at") <= now))

    def rate() -> DataFrame:
        r = recent().groupBy(status_class(F.col("status")).alias("status")).agg((F.count(F.lit(1)) / 300.0).alias("v"))
        return metric_samples(r, "api_request_rate_per_second", F.col("v"), {"status": F.col("status")}, now)

    def quantile(q: float) -> DataFrame:
        idx = F.size(F.filter(F.array(*[F.lit(float(b)) for b in LATENCY_BUCKETS_MS]), lambda b: b < F.col("latency_ms")))
        h = recent().where("latency_ms is not null").agg(F.array(*[F.coalesce(F.sum((idx == i).cast("bigint")), F.lit(0))
                                                                   for i in range(len(LATENCY_BUCKETS_MS))]).alias("counts"))
        h = h.withColumn("cum", cumulative(F.col("counts")))
        v = histogram_quantile(q, F.col("counts"), F.col("cum")) / 1000.0
        return metric_samples(h.where(F.element_at("cum", -1) > 0), f"api_latency_p{int(q * 100)}_seconds", v, {}, now)

    def errors() -> DataFrame:
        e = recent().agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_error").cast("bigint")).alias("e")).where("n > 0")
        return metric_samples(e, "api_error_rate_percent", 100.0 * F.col("e") / F.col("n"), {}, now)

    def newest(name: str, table: str, label: str, value: Column, at: str) -> DataFrame:
        g = tables[table].where(F.col(at) <= now).groupBy(label).agg(F.max_by(value, F.struct(F.col(at), value)).alias("v"))
        return metric_samples(g.where("v is not null"), name, F.col("v"), {label: F.col(label)}, now)

    def age() -> DataFrame:
        g = tables["predictions"].groupBy("source_table").agg(F.max("predicted_at").alias("at"))
        v = (F.unix_micros(now) - F.unix_micros(F.col("at").cast("timestamp"))) / 1e6
        return metric_samples(g, "predictions_staleness_seconds", v, {"source_table": F.col("source_table")}, now)

    return {
        "api_request_rate_per_second": rate,
        **{f"api_latency_p{int(q * 100)}_seconds": (lambda q=q: quantile(q)) for q in (0.50, 0.95, 0.99)},
        "api_error_rate_percent": errors,
        "pipeline_flow_status": lambda: newest("pipeline_flow_status", "flow_runs", "flow_name", run_status_code("status"), "ended_at"),
        "pipeline_flow_duration_seconds": lambda: newest("pipeline_flow_duration_seconds", "flow_runs", "flow_name", F.col("duration_s"), "ended_at"),
        "quality_gate_verdict": lambda: newest("quality_gate_verdict", "gate_runs", "source_table", verdict_code("verdict"), "run_at"),
        "predictions_staleness_seconds": age,
        "drift_psi": lambda: newest("drift_psi", "drift", "feature_name", F.col("psi"), "computed_at"),
        "drift_pvalue": lambda: newest("drift_pvalue", "drift", "feature_name", F.col("p_value"), "computed_at"),
        "drift_verdict": lambda: newest("drift_verdict", "drift", "feature_name", verdict_code("verdict"), "computed_at"),
    }


def publish(published: DataFrame, fresh: DataFrame) -> DataFrame:
    """T5: the newest value per (metric, labels) of what was published and a new
    snapshot; a spec that failed has no fresh rows, so its last value stays."""
    key = F.to_json("labels").alias("_labels")
    both = published.unionByName(fresh).select("*", key)
    return both.groupBy("metric_name", "_labels").agg(F.max_by(F.struct("value", "labels", "computed_at"), F.struct("computed_at", "value")).alias("x")) \
        .select("metric_name", "x.value", "x.labels", "x.computed_at")
