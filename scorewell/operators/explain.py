"""Explainability as data jobs (E1-E8, A21-A24) over a long attribution table.

Attributions are rows ``(row_id, feature, value, phi)``; every check is a
grouped aggregate over that table, so any attribution source fits.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.functions.columns import parent_feature
from scorewell.operators.metrics import average_precision, spearman_pearson
from scorewell.operators.ordered import BUCKET, hash_bucket, order_hash, rows_per_bucket
from scorewell.session import staged

# Thresholds of the explanation gates.
RELEVANCE_MIN = 0.5
DOMINANCE_MAX = 3.0
CV_MIN = 0.10
CONSISTENCY_MIN = 0.70
PEARSON_MIN = 0.05
TRIALS_BY_SCORE = {1: 100, 2: 30, 3: 0}


def linear_attribution(df: DataFrame, row_id: str, weights: Mapping[str, float],
                       means: Mapping[str, float], prefix: str | None = None) -> DataFrame:
    """``phi_j = w_j (x_j - mean_j)`` (closed form for independent features), long form;
    with ``prefix``, as columns ``prefix + feature`` beside those of ``df``."""
    if prefix is not None:
        return df.withColumns({prefix + f: F.lit(float(w)) * (F.col(f"`{f}`").cast("double") - F.lit(float(means[f]))) for f, w in weights.items()})
    structs = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value"),
                        (F.lit(float(w)) * (F.col(f"`{f}`").cast("double") - F.lit(float(means[f])))).alias("phi"))
               for f, w in weights.items()]
    return df.select(row_id, F.explode(F.array(*structs)).alias("a")).select(
        row_id, "a.feature", "a.value", "a.phi")


def background_means(df: DataFrame, features: Sequence[str]) -> dict:
    """Feature means of the background set (one aggregate)."""
    r = df.agg(*[F.avg(F.col(f"`{f}`").cast("double")).alias(f) for f in features]).first()
    return {f: r[f] for f in features}


def ensemble_attribution(attrs: Mapping[str, DataFrame], row_id: str, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(weighted) mean of several models' attributions per (row, feature), by one union + group."""
    weights = weights or {m: 1.0 for m in attrs}
    tot = float(sum(weights.values()))
    parts = [a.select(row_id, "feature", "value", (F.col("phi") * (weights[m] / tot)).alias("phi"))
             for m, a in attrs.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(row_id, "feature").agg(F.first("value").alias("value"), F.sum("phi").alias("phi"))


def ensemble_columns(df: DataFrame, row_id: str, features: Sequence[str], weights: Mapping[str, float]) -> DataFrame:
    """``ensemble_attribution`` of models whose attributions are columns ``prefix +
    feature`` of the same rows (``weights`` by prefix): the models are added up in place, and
    a row is shuffled once, not once per model and feature, to meet others of its id."""
    tot = float(sum(weights.values()))

    def both(f: str) -> Column:
        phis = [F.col(f"`{p}{f}`") * (w / tot) for p, w in weights.items()]
        return F.when(F.coalesce(*phis).isNotNull(), sum((F.coalesce(x, F.lit(0.0)) for x in phis[1:]), F.coalesce(phis[0], F.lit(0.0))))

    few = df.select(row_id, *[F.col(f"`{f}`").cast("double").alias(f"_v{i}") for i, f in enumerate(features)],
                    *[both(f).alias(f"_p{i}") for i, f in enumerate(features)])
    n = range(len(features))
    one = few.groupBy(row_id).agg(*[F.first(f"_v{i}").alias(f"_v{i}") for i in n], *[F.sum(f"_p{i}").alias(f"_p{i}") for i in n])
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"_v{i}").alias("value"), F.col(f"_p{i}").alias("phi")) for i, f in enumerate(features)])
    return one.select(row_id, F.explode(parts).alias("a")).select(row_id, "a.feature", "a.value", "a.phi")


def mean_abs(attr: DataFrame) -> DataFrame:
    """Mean |phi| per feature."""
    return attr.groupBy("feature").agg(F.avg(F.abs("phi")).alias("importance"))


def parent_importance(imp: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Max (not sum) importance per parent feature."""
    return (imp.withColumn("parent", parent_feature("feature", list(parents)))
            .groupBy("parent").agg(F.max("importance").alias("importance")))


def top_n(imp: DataFrame, name: str, n: int) -> DataFrame:
    """K5: the ``n`` most important (ties by name), with their 1-based rank."""
    w = Window.orderBy(F.col("importance").desc(), F.col(name))
    # the n rows are taken by a top-n plan (n rows per task) before they are numbered
    return imp.orderBy(F.col("importance").desc(), F.col(name)).limit(n).withColumn("rank", F.row_number().over(w))


def relevance(top: DataFrame, name: str, expected: Sequence[str], prefix_match: bool = False) -> DataFrame:
    """Share of the *expected* features found among the top ones.

    Exact names (gate 1), or also any feature that starts with ``name_`` (gate 2).
    """
    found = []
    for e in expected:
        hit = F.col(name) == e
        if prefix_match:
            hit = hit | F.col(name).startswith(e + "_")
        found.append(F.coalesce(F.max(hit.cast("int")), F.lit(0)))
    share = sum(found[1:], found[0]) / F.lit(float(len(expected)))
    return top.agg(share.alias("relevance"), F.count(F.lit(1)).alias("n_top")) \
        .withColumn("relevance_pass", F.col("relevance") >= RELEVANCE_MIN)


def magnitude(top: DataFrame) -> DataFrame:
    """Dominance (1st / 2nd; 2nd not positive -> inf; no 2nd -> 0) and
    coefficient of variation (population; mean not positive -> 0)."""
    a = top.agg(F.max(F.when(F.col("rank") == 1, F.col("importance"))).alias("first"),
                F.max(F.when(F.col("rank") == 2, F.col("importance"))).alias("second"),
                F.stddev_pop("importance").alias("sd"), F.avg("importance").alias("mean"))
    dom = F.when(F.col("second").isNull(), F.lit(0.0)).when(F.col("second") > 0, F.try_divide("first", "second")) \
        .otherwise(F.lit(float("inf")))
    cv = F.when(F.col("mean") > 0, F.try_divide("sd", "mean")).otherwise(F.lit(0.0))
    return a.select(dom.alias("dominance"), cv.alias("cv")).withColumn(
        "magnitude_pass", (F.col("dominance") <= DOMINANCE_MAX) & (F.col("cv") >= CV_MIN))


def garbage(top: DataFrame, name: str, unwanted: Sequence[str]) -> DataFrame:
    """Gate 2: none of the unwanted features is among the top ones."""
    return top.agg((F.coalesce(F.max(F.col(name).isin(list(unwanted)).cast("int")), F.lit(0)) == 0).alias("garbage_pass"))


def gate2(attr: DataFrame, permutation: DataFrame | None, expected: Sequence[str], unwanted: Sequence[str],
          expected_sign: Mapping[str, int], n_top: int = 10, n_garbage: int = 5) -> DataFrame:
    """E8, gate 2: overlap of the top features by attribution and by permutation
    importance (name or ``name_`` prefix), no unwanted feature in the first five,
    directions by Pearson.  All must pass; an ensemble has no permutation table,
    and then the other three decide."""
    imp = staged(mean_abs(attr), "importance")  # a row per feature, read by three checks
    parts = [relevance(top_n(imp, "feature", n_top), "feature", expected, True)
             .select(F.col("relevance").alias("attribution_overlap"), F.col("relevance_pass").alias("attribution_pass"))]
    if permutation is not None:
        parts.append(relevance(top_n(permutation, "feature", n_top), "feature", expected, True)
                     .select(F.col("relevance").alias("permutation_overlap"), F.col("relevance_pass").alias("permutation_pass")))
    parts.append(garbage(top_n(imp, "feature", n_garbage), "feature", unwanted))
    parts.append(direction_verdict(direction(attr, expected_sign, "pearson"), "pearson").select("direction_pass"))
    one = parts[0]
    for p in parts[1:]:
        one = one.crossJoin(p)  # one-row aggregates
    if permutation is None:
        one = one.withColumns({"permutation_overlap": F.lit(None).cast("double"), "permutation_pass": F.lit(None).cast("boolean")})
    ok = F.col("attribution_pass") & F.coalesce("permutation_pass", F.lit(True)) & F.col("garbage_pass") & F.col("direction_pass")
    return one.withColumn("all_pass", ok)


def direction(attr: DataFrame, expected_sign: Mapping[str, int], method: str = "spearman") -> DataFrame:
    """E5: per feature, sign of corr(value, phi) against the expected sign.

    Gate 1: Spearman, every checked feature must agree.  Gate 2: Pearson (NaN -> 0),
    only |r| > .05 counts, pass when correct >= max(1, round(2/3 checked)).
    """
    a = attr.where(F.col("feature").isin(list(expected_sign)))
    c = spearman_pearson(a, ["feature"], "value", "phi")
    exp = F.create_map(*[x for f, s in expected_sign.items() for x in (F.lit(f), F.lit(int(s)))])
    r = F.coalesce(F.col(method), F.lit(0.0)) if method == "pearson" else F.col(method)
    checked = (F.abs(r) > PEARSON_MIN) if method == "pearson" else r.isNotNull()
    return c.select("feature", r.alias("corr"), checked.alias("checked"),
                    (checked & (F.signum(r) == F.try_element_at(exp, F.col("feature")))).alias("correct"))


def direction_verdict(d: DataFrame, method: str = "spearman") -> DataFrame:
    a = d.agg(F.sum(F.col("checked").cast("int")).alias("checked"),
              F.sum(F.col("correct").cast("int")).alias("correct"))
    if method == "pearson":
        need = F.greatest(F.lit(1), F.round(F.col("checked") * 2.0 / 3.0).cast("int"))
        ok = F.col("correct") >= need
    else:
        ok = F.col("correct") == F.col("checked")
    return a.withColumn("direction_pass", ok)


def consistency(rank_a: DataFrame, rank_b: DataFrame, rank_c: DataFrame, name: str = "feature") -> DataFrame:
    """Mean of the three pairwise Spearman correlations of importance rankings (J5 + K7)."""
    j = (rank_a.select(name, F.col("importance").alias("a"))
         .join(rank_b.select(name, F.col("importance").alias("b")), name)
         .join(rank_c.select(name, F.col("importance").alias("c")), name))
    long = j.select(name, F.explode(F.array(
        F.struct(F.lit("ab").alias("pair"), F.col("a").alias("x"), F.col("b").alias("y")),
        F.struct(F.lit("ac").alias("pair"), F.col("a").alias("x"), F.col("c").alias("y")),
        F.struct(F.lit("bc").alias("pair"), F.col("b").alias("x"), F.col("c").alias("y")))).alias("p"))
    long = long.select(name, "p.pair", "p.x", "p.y")
    s = spearman_pearson(long, ["pair"], "x", "y")
    return s.agg(F.avg("spearman").alias("consistency")).withColumn(
        "consistency_pass", F.col("consistency") >= CONSISTENCY_MIN)


def scorecard(relevance_pass: Column, direction_pass: Column, magnitude_pass: Column,
              consistency_pass: Column) -> tuple[Column, Column]:
    """E8, gate 1: fail relevance or direction -> 3; magnitude and consistency pass
    -> 1; else 2; trials 100 / 30 / 0."""
    score = (F.when(~relevance_pass | ~direction_pass, F.lit(3))
             .when(magnitude_pass & consistency_pass, F.lit(1)).otherwise(F.lit(2)))
    trials = F.when(score == 1, F.lit(TRIALS_BY_SCORE[1])).when(score == 2, F.lit(TRIALS_BY_SCORE[2])) \
        .otherwise(F.lit(TRIALS_BY_SCORE[3]))
    return score, trials


def permutation_importance(df: DataFrame, key: str, label: str, features: Sequence[str],
                           score_fn, repeats: int = 5, seed: int = 42) -> DataFrame:
    """PR-AUC drop when one feature is shuffled; mean and population std over repeats.

    Rows are put in one seeded hash order per repeat, and every row gets the values of
    the row before it in that order (the first one those of the last): a random
    cyclic permutation, the same for all features of a repeat.  So rows are sorted
    once per repeat, in hash buckets, without a join of shuffled values; only then
    is each feature's variant scored, and scores are reduced at once.  ``df`` should
    hold only the key, the label and what ``score_fn`` reads.
    """
    buckets = math.ceil(df.count() / rows_per_bucket(df))
    buckets = 1 << max(0, (buckets - 1).bit_length())
    x = df.select("*", F.explode(F.array(*[F.lit(r) for r in range(repeats)])).alias("_repeat"))
    x = x.withColumn("_h", order_hash(F.col(key), F.lit(seed), F.col("_repeat")))
    # one number names repeat and bucket, and each value is carried once: this is what is shuffled
    x = x.withColumn(BUCKET, F.col("_repeat") * buckets + hash_bucket("_h", buckets)).drop("_repeat")
    w = Window.partitionBy(BUCKET).orderBy("_h", key)
    before = {f: f"_before_{i}" for i, f in enumerate(features)}
    own = {f: F.col(f"`{f}`").cast("double") for f in features}
    # the last row of a bucket; its columns follow one order, so they are one row's
    last = x.groupBy(BUCKET).agg(*[F.max_by(own[f], "_h").alias(f"_last_{b}") for f, b in before.items()])
    last = last.withColumn("_repeat", F.floor(F.col(BUCKET) / buckets))
    wb = Window.partitionBy("_repeat").orderBy(BUCKET)  # one row per repeat and bucket
    whole = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at_edge = F.row_number().over(wb) == 1
    edge = last.select(BUCKET, *[F.when(at_edge, F.last(f"_last_{b}").over(whole)).otherwise(F.lag(f"_last_{b}").over(wb)).alias(f"_edge{b}")
                                 for b in before.values()])
    x = x.select("*", *[F.lag(own[f]).over(w).alias(b) for f, b in before.items()], (F.row_number().over(w) == 1).alias("_first"))
    x = x.join(F.broadcast(edge), BUCKET)  # a row per repeat and two million rows
    x = x.withColumn("_repeat", F.floor(F.col(BUCKET) / buckets).cast("int"))
    x = x.withColumns({b: F.when(F.col("_first"), F.col(f"_edge{b}")).otherwise(F.col(b)) for b in before.values()})
    x = x.withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    for f in features:
        x = x.withColumn(f, F.when(F.col("_feature") == f, F.col(before[f])).otherwise(F.col(f"`{f}`")))
    scored = score_fn(x).select(F.col("_feature").alias("feature"), F.col("_repeat").alias("repeat"), label, "score")
    ap = average_precision(scored, ["feature", "repeat"], label=label)
    base = average_precision(score_fn(df).select(F.lit("_").alias("feature"), F.lit(0).alias("repeat"),
                                                 label, "score"), ["feature", "repeat"], label=label)
    base_ap = base.first()["average_precision"]  # one number
    return (ap.withColumn("drop", F.lit(base_ap) - F.col("average_precision"))
            .groupBy("feature").agg(F.avg("drop").alias("importance_mean"),
                                    F.stddev_pop("drop").alias("importance_std")))
