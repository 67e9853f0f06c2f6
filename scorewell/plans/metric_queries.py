"""Fixture queries: exact ranking metrics, threshold calibration, latency summaries.

Scored rows: two "models" over lineitem (``y = l_returnflag = 'R'``, scores
``l_discount * 10`` and ``l_tax / 0.08``, many ties) and one over labelled
documents (``y = quality``, score from ``n_chars``), in one long table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.columns import r6
from scorewell.operators import metrics as M
from scorewell.operators import models as MD
from scorewell.plans.tables import events, table


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    li = li.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                   F.explode(F.array(
                       F.struct(F.lit("li_discount").alias("model"), (F.col("l_discount") * 10).alias("score")),
                       F.struct(F.lit("li_tax").alias("model"), (F.col("l_tax") / 0.08).alias("score")))).alias("m"))
    li = li.select(F.col("m.model").alias("model"), "y", F.col("m.score").alias("score"))
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    dl = lab.join(doc, "doc_id").select(F.lit("doc_length").alias("model"), F.col("quality").alias("y"),
                                        (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("score"))
    return li.unionByName(dl)


SCORED_SQL = """
scored AS (
  SELECT 'li_discount' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS score FROM lineitem
  UNION ALL SELECT 'li_tax', CAST(l_returnflag = 'R' AS INTEGER), l_tax / 0.08 FROM lineitem
  UNION ALL SELECT 'doc_length', quality, n_chars / (n_chars + 2000.0) FROM labels JOIN documents USING (doc_id)
), sc AS (
  SELECT model, score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
  FROM scored WHERE score IS NOT NULL AND y IS NOT NULL AND NOT isnan(score) GROUP BY model, score
), pts AS (
  SELECT model, score AS threshold, pos, neg,
         sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
         sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
         sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg
  FROM sc
), curve AS (
  SELECT *, tp / (tp + fp) AS precision, CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 1.0 END AS recall,
         CASE WHEN n_neg > 0 THEN fp / n_neg END AS fpr
  FROM pts
)"""


def roc_auc(spark, sf_dir):
    return M.roc_auc(scored(spark, sf_dir), ["model"]).select("model", r6("roc_auc").alias("roc_auc"))


def average_precision(spark, sf_dir):
    return M.average_precision(scored(spark, sf_dir), ["model"]).select(
        "model", r6("average_precision").alias("average_precision"))


def pr_curve(spark, sf_dir):
    c = M.curve(scored(spark, sf_dir), ["model"])
    return c.select("model", r6(F.col("threshold") + 0.0).alias("threshold"), "tp", "fp",
                    r6("precision").alias("precision"), r6("recall").alias("recall"), r6("fpr").alias("fpr"))


def calibrated_threshold(spark, sf_dir):
    c = M.calibrate_threshold(scored(spark, sf_dir), ["model"])
    return c.select("model", r6(F.col("threshold") + 0.0).alias("threshold"), r6("f1").alias("f1"),
                    r6("recall").alias("recall"), r6("precision").alias("precision"), "calibration_mode")


def model_metadata(spark, sf_dir):
    """Registration row of every model: threshold, mode, confusion there, AUCs."""
    m = MD.model_metadata(scored(spark, sf_dir))
    return m.select("model", r6(F.col("threshold") + 0.0).alias("threshold"), "calibration_mode", "tp", "fp", "tn", "fn", "n", "positives",
                    *[r6(c).alias(c) for c in ("precision", "recall", "f1", "specificity", "accuracy", "roc_auc", "average_precision")])


def resource_summary(spark, sf_dir):
    """A16 (resources): peak and average of two samples per event type."""
    r = M.resource_summary(events(spark, sf_dir).withColumn("id", F.col("event_id").cast("double")), ["event_type"], "value", "id")
    return r.select("event_type", "sample_count", *[r6(c).alias(c) for c in ("cpu_peak", "cpu_avg", "memory_peak", "memory_avg")])


def confusion(spark, sf_dir):
    c = M.confusion(scored(spark, sf_dir), ["model"], 0.5)
    return c.select("model", "tp", "fp", "tn", "fn", *[r6(x).alias(x) for x in
                                                      ("precision", "recall", "f1", "specificity", "accuracy")])


def latency_summary_a(spark, sf_dir):
    """A15 per event type, ``value`` as latency."""
    s = M.latency_summary_a(events(spark, sf_dir), ["event_type"], "value")
    return s.select("event_type", "n", r6("p50").alias("p50"), r6("p95").alias("p95"),
                    r6("min").alias("min"), r6("max").alias("max"))


def latency_summary_b(spark, sf_dir):
    """A16 per day of events; ``error`` events are the failed requests."""
    ev = events(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    s = M.latency_summary_b(ev, ["day"], "value", F.col("event_type") == "error")
    return s.select("day", "request_total", "request_errors", r6("latency_p50").alias("latency_p50"),
                    r6("latency_p95").alias("latency_p95"))


def spearman(spark, sf_dir):
    """Spearman and Pearson of three lineitem columns against the extended price."""
    li = table(spark, sf_dir, "lineitem")
    long = li.select("l_extendedprice", F.explode(F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
          for c in ("l_quantity", "l_discount", "l_tax")])).alias("f"))
    long = long.select(F.col("f.feature").alias("feature"), F.col("f.x").alias("x"),
                       F.col("l_extendedprice").alias("y"))
    s = M.spearman_pearson(long, ["feature"], "x", "y")
    return s.select("feature", r6("spearman").alias("spearman"), r6("pearson").alias("pearson"))


QUERIES = {
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "pr_curve": pr_curve,
    "calibrated_threshold": calibrated_threshold,
    "model_metadata": model_metadata,
    "resource_summary": resource_summary,
    "confusion": confusion,
    "latency_summary_a": latency_summary_a,
    "latency_summary_b": latency_summary_b,
    "spearman": spearman,
}

_CALIBRATED = f"""WITH {SCORED_SQL}, f AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM curve
), best AS (
  SELECT model, arg_max({{'t': threshold, 'f1': f1, 'r': recall, 'p': precision}}, (f1, -threshold)) AS b
  FROM f GROUP BY model
), fl AS (
  SELECT model, arg_max({{'t': threshold, 'f1': f1, 'r': recall, 'p': precision}}, (f1, -threshold)) AS b
  FROM f WHERE recall >= 0.6 GROUP BY model
), pick AS (
  SELECT best.model, CASE WHEN best.b.r < 0.6 AND fl.b IS NOT NULL THEN fl.b ELSE best.b END AS c,
         CASE WHEN best.b.r < 0.6 AND fl.b IS NOT NULL THEN 'recall_floor_0.6' ELSE 'f1_optimal' END AS calibration_mode
  FROM best LEFT JOIN fl USING (model)
)"""

ORACLE = {
    "model_metadata": _CALIBRATED + """, m AS (
  SELECT model, c.t AS t, calibration_mode, count_if(score >= c.t AND y = 1) AS tp, count_if(score >= c.t AND y <> 1) AS fp,
         count_if(score < c.t AND y <> 1) AS tn, count_if(score < c.t AND y = 1) AS fn FROM scored JOIN pick USING (model) GROUP BY ALL
), a AS (
  SELECT model, CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (2 * tp - pos)) / (2.0 * max(n_pos) * max(n_neg)) END AS roc_auc,
         CASE WHEN max(n_pos) > 0 THEN sum(pos / n_pos * precision) END AS average_precision FROM curve GROUP BY model
), r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS p, coalesce(tp / nullif(tp + fn, 0), 0.0) AS rc FROM m JOIN a USING (model))
SELECT model, round(t + 0.0, 6) AS threshold, calibration_mode, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn,
       CAST(fn AS BIGINT) AS fn, CAST(tp + fp + tn + fn AS BIGINT) AS n, CAST(tp + fn AS BIGINT) AS positives, round(p, 6) AS precision,
       round(rc, 6) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0.0), 6) AS f1,
       round(coalesce(tn / nullif(tn + fp, 0), 0.0), 6) AS specificity, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
       round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM r""",
    "resource_summary": """SELECT event_type, count(*) AS sample_count, round(max(value), 6) AS cpu_peak, round(avg(value), 6) AS cpu_avg,
       CAST(max(event_id) AS DOUBLE) AS memory_peak, round(avg(event_id), 6) AS memory_avg FROM events GROUP BY event_type""",
    "roc_auc": f"""WITH {SCORED_SQL}
SELECT model, round(CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0
                    THEN sum(neg * (2 * tp - pos)) / (2.0 * max(n_pos) * max(n_neg)) END, 6) AS roc_auc
FROM curve GROUP BY model""",
    "average_precision": f"""WITH {SCORED_SQL}
SELECT model, round(CASE WHEN max(n_pos) > 0 THEN sum(pos / n_pos * precision) END, 6) AS average_precision
FROM curve GROUP BY model""",
    "pr_curve": f"""WITH {SCORED_SQL}
SELECT model, round(threshold + 0.0, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(fpr, 6) AS fpr
FROM curve""",
    "calibrated_threshold": f"""WITH {SCORED_SQL}, f AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM curve
), best AS (
  SELECT model, arg_max({{'t': threshold, 'f1': f1, 'r': recall, 'p': precision}}, (f1, -threshold)) AS b
  FROM f GROUP BY model
), fl AS (
  SELECT model, arg_max({{'t': threshold, 'f1': f1, 'r': recall, 'p': precision}}, (f1, -threshold)) AS b
  FROM f WHERE recall >= 0.6 GROUP BY model
), pick AS (
  SELECT best.model, CASE WHEN best.b.r < 0.6 AND fl.b IS NOT NULL THEN fl.b ELSE best.b END AS c,
         CASE WHEN best.b.r < 0.6 AND fl.b IS NOT NULL THEN 'recall_floor_0.6' ELSE 'f1_optimal' END AS calibration_mode
  FROM best LEFT JOIN fl USING (model)
)
SELECT model, round(c.t + 0.0, 6) AS threshold, round(c.f1, 6) AS f1, round(c.r, 6) AS recall,
       round(c.p, 6) AS precision, calibration_mode FROM pick""",
    "confusion": """WITH scored AS (
  SELECT 'li_discount' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS score FROM lineitem
  UNION ALL SELECT 'li_tax', CAST(l_returnflag = 'R' AS INTEGER), l_tax / 0.08 FROM lineitem
  UNION ALL SELECT 'doc_length', quality, n_chars / (n_chars + 2000.0) FROM labels JOIN documents USING (doc_id)
), c AS (
  SELECT model, CAST(count_if(score >= 0.5 AND y = 1) AS BIGINT) AS tp, CAST(count_if(score >= 0.5 AND y <> 1) AS BIGINT) AS fp,
         CAST(count_if(score < 0.5 AND y <> 1) AS BIGINT) AS tn, CAST(count_if(score < 0.5 AND y = 1) AS BIGINT) AS fn
  FROM scored GROUP BY model
), r AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall FROM c
)
SELECT model, tp, fp, tn, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) AS f1,
       round(coalesce(tn / nullif(tn + fp, 0), 0.0), 6) AS specificity,
       round(coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0), 6) AS accuracy
FROM r""",
    "latency_summary_a": """
SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50,
       round(list_sort(list(value))[CAST(least(round_even(0.95::DOUBLE * (count(*) - 1), 0), count(*) - 1) AS BIGINT) + 1], 6) AS p95,
       round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events WHERE value IS NOT NULL GROUP BY event_type""",
    "latency_summary_b": """
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, * FROM events),
v AS (SELECT day, list_sort(list(value) FILTER (WHERE value IS NOT NULL)) AS s FROM e GROUP BY day)
SELECT day, count(*) AS request_total, CAST(count_if(event_type = 'error') AS BIGINT) AS request_errors,
       round(s[least(len(s) - 1, CAST(floor(len(s) * 0.5::DOUBLE) AS BIGINT)) + 1], 6) AS latency_p50,
       round(s[least(len(s) - 1, CAST(floor(len(s) * 0.95::DOUBLE) AS BIGINT)) + 1], 6) AS latency_p95
FROM e JOIN v USING (day) GROUP BY day, s""",
    "spearman": """
WITH long AS (
  SELECT 'l_quantity' AS feature, CAST(l_quantity AS DOUBLE) AS x, l_extendedprice AS y FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount, l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_tax', l_tax, l_extendedprice FROM lineitem
), d AS (SELECT * FROM long WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (
  SELECT feature, x, y,
         rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry
  FROM d
)
SELECT feature, round(corr(rx, ry), 6) AS spearman, round(corr(x, y), 6) AS pearson FROM r GROUP BY feature""",
}
