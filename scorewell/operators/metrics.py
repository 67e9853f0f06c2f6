"""Exact classification and latency metrics.

Scores are reduced to one row per distinct score (positive / negative counts),
then ``running_totals`` gives the confusion counts at every threshold without a
single-partition window.  ROC-AUC counts ties as half; average precision is the
step sum ``sum (R_n - R_{n-1}) P_n`` without interpolation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.operators.ordered import null_safe_join, pick_by_rank, running_totals, value_ranks, with_totals
from scorewell.session import staged

RECALL_FLOOR = 0.60


def score_counts(df: DataFrame, keys: Sequence[str], score: str, label: str, weight: str | None = None) -> DataFrame:
    """(keys, score, pos, neg) with one row per distinct score; null scores / labels
    dropped.  ``weight``: a column with the number of rows that each row stands for."""
    w = F.col(weight) if weight else F.lit(1)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(score))
            .groupBy(*keys, score)
            .agg(F.sum((F.col(label) == 1).cast("bigint") * w).alias("pos"),
                 F.sum((F.col(label) != 1).cast("bigint") * w).alias("neg")))


def curve(df: DataFrame, keys: Sequence[str], score: str = "score", label: str = "y", weight: str | None = None) -> DataFrame:
    """One point per distinct score: ``tp, fp`` of ``score >= threshold``, precision, recall, fpr.

    The counts are written once: cut points, bucket totals and every metric of the
    points read them, and ``df`` is scored and shuffled a single time."""
    sc = staged(score_counts(df, keys, score, label, weight), "score-counts")
    rt = running_totals(sc, keys, [score], ["pos", "neg"], descending=True)
    rt = with_totals(rt, keys, {"_p": F.col("pos"), "_n": F.col("neg")})
    P, N = F.col("_p").cast("double"), F.col("_n").cast("double")
    return rt.select(
        *keys, F.col(score).alias("threshold"), "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        P.alias("n_pos"), N.alias("n_neg"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(P > 0, F.col("cum_pos") / P).otherwise(F.lit(1.0)).alias("recall"),
        F.try_divide(F.col("cum_neg").cast("double"), N).alias("fpr"))


def roc_auc(df: DataFrame, keys: Sequence[str], score: str = "score", label: str = "y",
            points: DataFrame | None = None) -> DataFrame:
    """Trapezoidal ROC area = Mann-Whitney with ties counted half.  Null if a class is absent."""
    c = points if points is not None else curve(df, keys, score, label)
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")))
    return (c.groupBy(*keys)
            .agg((area / (2.0 * F.first("n_pos") * F.first("n_neg"))).alias("_a"),
                 F.first("n_pos").alias("_p"), F.first("n_neg").alias("_n"))
            .select(*keys, F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_a")).alias("roc_auc")))


def average_precision(df: DataFrame, keys: Sequence[str], score: str = "score", label: str = "y",
                      points: DataFrame | None = None) -> DataFrame:
    """``sum over thresholds of (pos / P) * precision``; null without positives."""
    c = points if points is not None else curve(df, keys, score, label)
    return (c.groupBy(*keys)
            .agg(F.sum(F.col("pos") / F.col("n_pos") * F.col("precision")).alias("_ap"),
                 F.first("n_pos").alias("_p"))
            .select(*keys, F.when(F.col("_p") > 0, F.col("_ap")).alias("average_precision")))


def calibrate_threshold(df: DataFrame, keys: Sequence[str], score: str = "score", label: str = "y",
                        recall_floor: float = RECALL_FLOOR, points: DataFrame | None = None, counts: bool = False) -> DataFrame:
    """First F1 maximum (lowest threshold on ties); below the recall floor take the
    best F1 among thresholds whose recall reaches the floor.  ``counts`` adds the
    confusion counts (tp, fp, tn, fn) of the curve there."""
    c = points if points is not None else curve(df, keys, score, label)
    pr = F.col("precision") + F.col("recall")
    c = c.withColumn("f1", F.when(pr > 0, 2 * F.col("precision") * F.col("recall") / pr).otherwise(0.0))
    pick = F.struct("threshold", "f1", "recall", "precision", "tp", "fp", "n_pos", "n_neg")
    order = F.struct("f1", (-F.col("threshold")).alias("nt"))
    agg = c.groupBy(*keys).agg(
        F.max_by(pick, order).alias("best"),
        F.max_by(F.when(F.col("recall") >= recall_floor, pick),
                 F.when(F.col("recall") >= recall_floor, order)).alias("floor"))
    use_floor = (F.col("best.recall") < recall_floor) & F.col("floor").isNotNull()
    chosen = F.when(use_floor, F.col("floor")).otherwise(F.col("best"))
    return agg.select(*keys, chosen["threshold"].alias("threshold"), chosen["f1"].alias("f1"),
                      chosen["recall"].alias("recall"), chosen["precision"].alias("precision"),
                      F.when(use_floor, F.lit(f"recall_floor_{recall_floor}"))
                      .otherwise(F.lit("f1_optimal")).alias("calibration_mode"),
                      *([chosen["tp"].alias("tp"), chosen["fp"].alias("fp"),
                         (chosen["n_neg"].cast("bigint") - chosen["fp"]).alias("tn"),
                         (chosen["n_pos"].cast("bigint") - chosen["tp"]).alias("fn")] if counts else []))


def confusion(df: DataFrame, keys: Sequence[str], threshold: float | str = 0.5, score: str = "score",
              label: str = "y") -> DataFrame:
    """Confusion counts at ``score >= threshold`` and the derived rates (x/0 -> 0)."""
    t = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    pred = (F.col(score) >= t)
    yes = F.col(label) == 1
    a = df.groupBy(*keys).agg(
        F.sum((pred & yes).cast("bigint")).alias("tp"), F.sum((pred & ~yes).cast("bigint")).alias("fp"),
        F.sum((~pred & ~yes).cast("bigint")).alias("tn"), F.sum((~pred & yes).cast("bigint")).alias("fn"))
    return confusion_rates(a, keys)


def confusion_rates(a: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rates of confusion counts (x/0 -> 0)."""
    def d(x, y):
        return F.coalesce(F.try_divide(x.cast("double"), y.cast("double")), F.lit(0.0))

    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    prec, rec = d(tp, tp + fp), d(tp, tp + fn)
    return a.select(*keys, "tp", "fp", "tn", "fn", prec.alias("precision"), rec.alias("recall"),
                    d(2 * prec * rec, prec + rec).alias("f1"), d(tn, tn + fp).alias("specificity"),
                    d(tp + tn, tp + tn + fp + fn).alias("accuracy"))


# ---------------------------------------------------------------- latency summaries
def _value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
            .agg(F.count(F.lit(1)).alias("_n")))


def latency_summary_a(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """N, median (mean of the two middle values when n is even), p95 = element at
    ``round(0.95 (n-1))`` (half-even), min, max."""
    picks = pick_by_rank(_value_counts(df, keys, value), keys, value, "_n", lambda n: {
        "lo": F.floor((n - 1) / 2), "hi": F.floor(n / 2), "p95": F.least(F.rint(0.95 * (n - 1)), n - 1)})
    g = picks.groupBy(*keys).agg(
        F.avg(F.when(F.col("name").isin("lo", "hi"), F.col(value))).alias("_mid2"),
        F.first(F.when(F.col("name") == "lo", F.col(value)), True).alias("_lo"),
        F.first(F.when(F.col("name") == "hi", F.col(value)), True).alias("_hi"),
        F.first(F.when(F.col("name") == "p95", F.col(value)), True).alias("p95"))
    stats = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    return null_safe_join(stats, g, keys, "left").select(
        *keys, "n", ((F.col("_lo") + F.col("_hi")) / 2.0).alias("p50"), "p95", "min", "max")


def latency_summary_b(df: DataFrame, keys: Sequence[str], value: str, is_error: Column) -> DataFrame:
    """Totals, errors, p50 / p95 at index ``min(n-1, int(n p))``."""
    picks = pick_by_rank(_value_counts(df, keys, value), keys, value, "_n", lambda n: {
        "p50": F.least(n - 1, F.floor(n * 0.5)), "p95": F.least(n - 1, F.floor(n * 0.95))})
    g = picks.groupBy(*keys).agg(
        F.first(F.when(F.col("name") == "p50", F.col(value)), True).alias("latency_p50"),
        F.first(F.when(F.col("name") == "p95", F.col(value)), True).alias("latency_p95"))
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("request_total"),
                                  F.sum(is_error.cast("bigint")).alias("request_errors"))
    return null_safe_join(stats, g, keys, "left")


def resource_summary(df: DataFrame, keys: Sequence[str], cpu: str, mem: str) -> DataFrame:
    """A16 (resources): peak and average of the CPU and memory samples."""
    return df.groupBy(*keys).agg(F.max(cpu).alias("cpu_peak"), F.avg(cpu).alias("cpu_avg"),
                                 F.max(mem).alias("memory_peak"), F.avg(mem).alias("memory_avg"),
                                 F.count(F.lit(1)).alias("sample_count"))


# ---------------------------------------------------------------- correlation
def spearman_pearson(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Spearman (Pearson on average ranks) and Pearson per key; rows with a null dropped.

    Rows are reduced to distinct (key, x, y) with counts once; ranks are joined to
    that table and the correlations are weighted sums about the means (the mean rank
    is known).  Counts, ranks and means are written once, so the pairs are read once for
    each and the planner knows which of them are small enough not to shuffle the pairs.
    Null for a single row, NaN where a side is constant.
    """
    pairs = staged(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, x, y).agg(F.count(F.lit(1)).alias("_n")), "correlation")
    ranked = pairs
    for v, out in ((x, "_rx"), (y, "_ry")):
        counts = staged(pairs.groupBy(*keys, v).agg(F.sum("_n").alias("_c")), "correlation-counts")
        ranked = null_safe_join(ranked, staged(value_ranks(counts, keys, v, "_c", out), "correlation-ranks"), [*keys, v])
    n = F.col("_n")
    means = pairs.groupBy(*keys).agg(F.sum("_n").alias("_all"), *[(F.sum(n * F.col(v).cast("double")) / F.sum("_n")).alias(m)
                                                                 for v, m in ((x, "_mx"), (y, "_my"))])
    j = null_safe_join(ranked, staged(means, "correlation-means"), keys)  # a row per key
    mid = (F.col("_all") + 1) / 2.0
    sums = []
    for name, a, b in (("s", F.col("_rx") - mid, F.col("_ry") - mid), ("p", F.col(x) - F.col("_mx"), F.col(y) - F.col("_my"))):
        sums += [F.sum(n * a * b).alias(f"_{name}xy"), F.sum(n * a * a).alias(f"_{name}xx"), F.sum(n * b * b).alias(f"_{name}yy")]
    g = j.groupBy(*keys).agg(F.max("_all").alias("_all"), *sums)

    def corr(name: str) -> Column:
        size = F.sqrt(F.col(f"_{name}xx")) * F.sqrt(F.col(f"_{name}yy"))
        return F.when(F.col("_all") > 1, F.when(size > 0, F.try_divide(F.col(f"_{name}xy"), size)).otherwise(F.lit(float("nan"))))

    return g.select(*keys, corr("s").alias("spearman"), corr("p").alias("pearson"))
