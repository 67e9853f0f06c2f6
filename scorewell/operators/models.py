"""Training, scoring, selection and promotion.

Spark ML estimators stand in for the reference's boosted-tree libraries; the
procedure is matched (class weights, soft voting, threshold per version,
lineage, all-or-nothing append), not the coefficients.
"""

from __future__ import annotations

import itertools
import json
import os
import random
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.functions.columns import label_from_threshold
from scorewell.operators import metrics as M
from scorewell.operators import validate as V
from scorewell.operators.booster import HistogramBooster
from scorewell.operators.latest import latest
from scorewell.operators.ordered import null_safe_join
from scorewell.operators.sampling import class_weights
from scorewell.operators.search import draw_uniform, fit_pipeline, fold_score, is_parameter_error
from scorewell.operators.smote import smote
from scorewell.session import staged

# Production threshold, candidate filter, promotion advisory gap.
DEFAULT_THRESHOLD = 0.6238
MIN_RECALL = 0.75
MAX_PR_AUC_GAP = 0.02
PROMOTION_RATE_GAP = 20.0
ENSEMBLE_WEIGHTS = [5, 3, 1]


# ---------------------------------------------------------------- M1 / M2
def estimators(features_col: str = "features", label: str = "y", weight_col: str | None = None,
               seed: int = 42, trees: int = 20) -> dict:
    """M1: the model family: two boosters of different make (``trees`` each), random
    forest (twice as many), logistic regression."""
    kw = {"featuresCol": features_col, "labelCol": label}
    if weight_col:
        kw["weightCol"] = weight_col
    return {
        "gradient_trees": GBTClassifier(maxDepth=4, maxIter=trees, seed=seed, **kw),
        "histogram_trees": HistogramBooster(maxIter=trees, maxLeaves=15, maxDepth=4, seed=seed, **kw),
        "random_forest": RandomForestClassifier(numTrees=2 * trees, maxDepth=6, seed=seed, **kw),
        "logistic": LogisticRegression(maxIter=50, regParam=0.01, **kw),
    }


def train_family(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str = "y", key: str = "id",
                 neighbours: int = 5, seed: int = 42, trees: int = 20, parallel: int = 4) -> DataFrame:
    """M1 + M2: the eight runs (each model with balanced class weights and with SMOTE) and
    the two soft votes, one result row each; a run that fails is a row.

    ``train`` and ``valid`` hold a whole-number ``key``, the label and the features.
    """
    # Runs of a kind are fitted side by side (their jobs are many and short where rows are
    # few), then score the validation rows together, once.
    spark = train.sparkSession
    train, valid = train.persist(), valid.persist()
    balanced = {"weight": class_weights(train, label), "smote": staged(smote(train, label, key, features, neighbours, seed), "smote-rows")}
    rows = []
    for kind, rows_in in balanced.items():
        rows_in, models, failed = rows_in.persist(), {}, {}
        family = estimators(label=label, weight_col="weight" if kind == "weight" else None, seed=seed, trees=trees)
        rows_in.count()  # cached once, before several fits ask for it
        with ThreadPoolExecutor(parallel) as pool:
            runs = {f"{name}+{kind}": pool.submit(inheritable_thread_target(spark)(train_evaluate), spark, f"{name}+{kind}", est, features, rows_in, None, label)
                    for name, est in family.items()}
        for run, (model, r) in ((run, f.result()) for run, f in runs.items()):
            if model is None:
                failed[run] = r
            else:
                models[run] = model
        rows_in.unpersist()
        got = failed | evaluate_models(models, valid, f"soft_vote+{kind}", label)
        rows += [got[r] for r in [f"{name}+{kind}" for name in family] + [f"soft_vote+{kind}"] if r in got]
    train.unpersist()
    valid.unpersist()
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def probability(pred: DataFrame, out: str = "score") -> DataFrame:
    """Positive-class probability as a double column."""
    return pred.withColumn(out, vector_to_array(F.col("probability"))[1])


def evaluate(scored: DataFrame, name: str, label: str = "y") -> dict:
    """The result row of a scored validation set."""
    return evaluate_all(scored.select(F.lit(name).alias("model"), label, "score"), label)[name]


def evaluate_all(scored: DataFrame, label: str = "y") -> dict:
    """The result rows of the ``model`` column's models, by name."""
    pts = M.curve(scored, ["model"], label=label)
    rows = (M.roc_auc(None, ["model"], points=pts).join(M.average_precision(None, ["model"], points=pts), "model")
            .join(M.confusion(scored, ["model"], 0.5, label=label), "model").collect())  # a row per model
    return {r["model"]: {"model": r["model"], "status": "ok", "error": None, "roc_auc": r["roc_auc"], "pr_auc": r["average_precision"],
                         "f1": r["f1"], "recall": r["recall"], "precision": r["precision"]} for r in rows}


def evaluate_models(models: dict, valid: DataFrame, vote: str, label: str = "y") -> dict:
    """The result rows of fitted models and of their soft vote, by name.

    Every model scores the rows once, and all scores are evaluated together.  Where that
    fails, each model is evaluated alone: one that fails is a row and has no vote."""
    if not models:
        return {}
    scored, votes = valid, [f"p{i}" for i in range(len(models))]
    for p, model in zip(votes, models.values()):
        scored = probability(model.transform(scored), p).drop("features", "rawPrediction", "probability", "prediction")
    named = [(n, F.col(p)) for n, p in zip(models, votes)] + [(vote, soft_vote(votes))]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), s.alias("score")) for n, s in named])).alias("s")
    scored = scored.select(label, *votes).persist()
    try:
        rows = evaluate_all(scored.select(label, each).select("s.model", label, "s.score"), label)
        return {n: rows[n] for n, _s in named}
    except Exception:  # noqa: BLE001 - found out below
        alone = {n: _recorded(n, lambda m=m, n=n: evaluate(probability(m.transform(valid)), n, label)) for n, m in models.items()}
        good = {n: m for n, m in models.items() if alone[n]["status"] == "ok"}
        if len(good) == len(models):
            raise
        return alone | evaluate_models(good, valid, vote, label)
    finally:
        scored.unpersist()


def _recorded(name: str, run: Callable[[], dict]) -> dict:
    try:
        return run()
    except Exception as e:  # noqa: BLE001 - recorded, not raised
        return {"model": name, "status": "failed", "error": str(e), "roc_auc": None,
                "pr_auc": None, "f1": None, "recall": None, "precision": None}


def train_evaluate(spark: SparkSession, name: str, estimator, features: Sequence[str], train: DataFrame,
                   valid: DataFrame | None, label: str = "y") -> tuple[PipelineModel | None, dict]:
    """M2: fit + evaluate (not without ``valid``); a failure is recorded as a row, not raised."""
    models = []

    def run() -> dict:
        models.append(fit_pipeline(train, features, estimator))
        return evaluate(probability(models[0].transform(valid)), name, label) if valid is not None else {"model": name, "status": "ok"}

    r = _recorded(name, run)
    return (models[0] if r["status"] == "ok" else None), r


RESULT_SCHEMA = ("model string, status string, error string, roc_auc double, pr_auc double, f1 double, "
                 "recall double, precision double")


# ---------------------------------------------------------------- M3 / M5
def soft_vote(probs: Sequence[Column | str], weights: Sequence[float] | None = None) -> Column:
    """M3: weighted mean of probabilities."""
    weights = list(weights or [1.0] * len(probs))
    cols = [F.col(p) if isinstance(p, str) else p for p in probs]
    num = cols[0] * F.lit(float(weights[0]))
    for c, w in zip(cols[1:], weights[1:]):
        num = num + c * F.lit(float(w))
    return num / F.lit(float(sum(weights)))


def weight_grid(n_models: int, values: Sequence[int] = (1, 2, 3, 4, 5)) -> list[tuple]:
    return list(itertools.product(values, repeat=n_models))


def weight_search(df: DataFrame, probs: Sequence[str], label: str = "y",
                  values: Sequence[int] = (1, 2, 3, 4, 5)) -> DataFrame:
    """M5: average precision of the soft vote for every weight tuple, scored in ONE job.

    Rows are first reduced to distinct (label, probabilities) with counts; only that
    table is expanded by the fixed grid (``len(values) ** k`` tuples, a literal), and
    equal scores collapse again before the metric is grouped by the tuple.
    """
    grid = weight_grid(len(probs), values)
    wnames = [f"w{i + 1}" for i in range(len(probs))]
    arr = F.array(*[F.struct(*[F.lit(int(v)).alias(n) for v, n in zip(t, wnames)]) for t in grid])
    few = df.groupBy(label, *probs).agg(F.count(F.lit(1)).alias("_rows"))
    e = few.select(label, *probs, "_rows", F.explode(arr).alias("_w")) \
        .select(label, *probs, "_rows", *[F.col(f"_w.{n}").alias(n) for n in wnames])
    num = F.col(probs[0]) * F.col(wnames[0])
    for p, n in zip(probs[1:], wnames[1:]):
        num = num + F.col(p) * F.col(n)
    den = F.col(wnames[0])
    for n in wnames[1:]:
        den = den + F.col(n)
    e = e.withColumn("score", num / den)
    return M.average_precision(e, wnames, label=label, points=M.curve(e, wnames, label=label, weight="_rows"))


# ---------------------------------------------------------------- selection
def candidate_filter(results: DataFrame, recall: str = "recall", val: str = "pr_auc_val",
                     test: str = "pr_auc_test") -> Column:
    """Recall >= .75 and |val - test PR-AUC| <= .02."""
    return (F.col(recall) >= MIN_RECALL) & (F.abs(F.col(val) - F.col(test)) <= MAX_PR_AUC_GAP)


def rank_models(results: DataFrame, by: Sequence[str] = ("pr_auc_test", "recall")) -> DataFrame:
    """Rank passing models by PR-AUC then recall, both descending (tiny table)."""
    passed = candidate_filter(results)
    w = Window.partitionBy("passed").orderBy(*[F.col(c).desc() for c in by], F.col("model"))
    r = results.withColumn("passed", passed)
    return r.withColumn("rank", F.when(F.col("passed"), F.row_number().over(w)))


def model_metadata(scored: DataFrame, keys: Sequence[str] = ("model",), score: str = "score", label: str = "y") -> DataFrame:
    """One row per model for its registration: calibrated threshold and mode, the
    confusion counts and rates there, ROC-AUC, average precision, rows and positives.

    The counts at the threshold are those of the curve's point, so rows are never joined
    with their model's threshold; a NaN score, which the curve leaves out, is above it."""
    keys = list(keys)
    pts = M.curve(scored, keys, score, label)
    cal = M.calibrate_threshold(scored, keys, score, label, points=pts, counts=True)
    odd = scored.where(F.isnan(score) & F.col(label).isNotNull()).groupBy(*keys).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("_pos"), F.sum((F.col(label) != 1).cast("bigint")).alias("_neg"))
    cal = null_safe_join(cal.drop("f1", "recall", "precision"), odd, keys, "left")
    cal = cal.withColumns({"tp": F.col("tp") + F.coalesce("_pos", F.lit(0)), "fp": F.col("fp") + F.coalesce("_neg", F.lit(0))})
    cal = staged(cal.drop("_pos", "_neg"), "calibration")  # a row per model
    con = M.confusion_rates(cal, keys)
    auc = null_safe_join(M.roc_auc(None, keys, points=pts), M.average_precision(None, keys, points=pts), keys)
    out = null_safe_join(null_safe_join(cal.select(*keys, "threshold", "calibration_mode"), con, keys), auc, keys)
    return out.withColumn("n", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).withColumn("positives", F.col("tp") + F.col("fn"))


def regression_report(tuned: DataFrame, baseline: DataFrame, key: str = "model",
                      metrics: Sequence[str] = ("pr_auc", "recall", "f1")) -> DataFrame:
    """Tuned - baseline per metric; negative = regression."""
    j = tuned.alias("t").join(baseline.alias("b"), key)
    return j.select(key, *[(F.col(f"t.{m}") - F.col(f"b.{m}")).alias(f"{m}_diff") for m in metrics],
                    *[(F.col(f"t.{m}") < F.col(f"b.{m}")).alias(f"{m}_regressed") for m in metrics])


# ---------------------------------------------------------------- promotion
def promotion_check(df: DataFrame, champion: str, candidate: str, threshold: float = 0.5) -> DataFrame:
    """Both scores in one projection; NaN / null / out of range = mandatory failure;
    a positive-rate gap >= 20 points is advisory."""
    def bad(c):
        return F.col(c).isNull() | F.isnan(c) | (F.col(c) < 0) | (F.col(c) > 1)
    a = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(bad(champion).cast("bigint")).alias("champion_invalid"),
               F.sum(bad(candidate).cast("bigint")).alias("candidate_invalid"),
               (100.0 * F.avg((F.col(champion) >= threshold).cast("double"))).alias("champion_rate_pct"),
               (100.0 * F.avg((F.col(candidate) >= threshold).cast("double"))).alias("candidate_rate_pct"))
    diff = F.abs(F.col("candidate_rate_pct") - F.col("champion_rate_pct"))
    return a.select("*", diff.alias("rate_diff_pct"),
                    (F.col("candidate_invalid") == 0).alias("mandatory_pass"),
                    (diff < PROMOTION_RATE_GAP).alias("advisory_pass"))


# ---------------------------------------------------------------- parity
def parity_compare(a: DataFrame, b: DataFrame, key: str, numeric: Sequence[str], exact: Sequence[str] = (),
                   rtol: float = 1e-6, atol: float = 1e-8) -> DataFrame:
    """Keyed compare; numerics within ``|a - b| <= atol + rtol |b|``, the rest exactly.

    Full outer join on the key (a missing side is a mismatch); one row per column.
    """
    j = a.select(key, *[F.col(c).alias(f"a_{c}") for c in (*numeric, *exact)]).join(
        b.select(key, *[F.col(c).alias(f"b_{c}") for c in (*numeric, *exact)]), key, "full_outer")
    structs = []
    for c in numeric:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        ok = F.coalesce(F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y), F.lit(False)) | (x.isNull() & y.isNull())
        structs.append(F.struct(F.lit(c).alias("column"), ok.alias("ok"), F.abs(x - y).alias("diff")))
    for c in exact:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        structs.append(F.struct(F.lit(c).alias("column"), x.eqNullSafe(y).alias("ok"),
                                F.lit(None).cast("double").alias("diff")))
    long = j.select(F.explode(F.array(*structs)).alias("s"))
    return long.groupBy(F.col("s.column").alias("column")).agg(
        F.count(F.lit(1)).alias("n_compared"), F.sum((~F.col("s.ok")).cast("bigint")).alias("n_mismatch"),
        F.max("s.diff").alias("max_abs_diff"))


# ---------------------------------------------------------------- bundle, alias, scoring
def save_bundle(root: str, version: str, prep, model: PipelineModel, threshold: float) -> str:
    """Preparation params + model + threshold saved together under ``root/version``."""
    path = os.path.join(root, version)
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"version": version, "threshold": threshold, "prep": prep.to_json() if prep else None})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(
        os.path.join(path, "meta"))
    # the registry's row comes last: a version that is listed is whole
    spark.createDataFrame([(version, float(threshold), type(model.stages[-1]).__name__, time.time_ns())], VERSIONS_SCHEMA).coalesce(1) \
        .write.mode("append").parquet(os.path.join(root, "_versions"))
    return path


VERSIONS_SCHEMA = "version string, threshold double, kind string, saved_ns bigint"


def model_versions(spark: SparkSession, root: str) -> DataFrame:
    """The registry's versions, newest registration of each."""
    try:
        log = spark.read.schema(VERSIONS_SCHEMA).parquet(os.path.join(root, "_versions"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], VERSIONS_SCHEMA)
    return log.groupBy("version").agg(F.max_by(F.struct("threshold", "kind", "saved_ns"), "saved_ns").alias("x")).select("version", "x.*")


def load_bundle(root: str, version: str):
    from scorewell.operators.features import FittedPrep
    spark = SparkSession.getActiveSession()
    path = os.path.join(root, version)
    meta = json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
    prep = FittedPrep.from_json(meta["prep"]) if meta["prep"] else None
    return prep, PipelineModel.load(os.path.join(path, "model")), float(meta["threshold"])


def set_alias(spark: SparkSession, log_path: str, alias: str, version: str) -> None:
    """M7: the alias log is append-only; the newest row per alias wins (rollback = set
    again).  ``seq`` is the setter's clock in nanoseconds and breaks equal times."""
    spark.createDataFrame([(alias, version, time.time_ns())], "alias string, version string, seq bigint") \
        .withColumn("set_at", F.current_timestamp()).write.mode("append").parquet(log_path)


def resolve_alias(spark: SparkSession, log_path: str, alias: str) -> str:
    """M7: latest version of an alias (K1 over the log: one row reaches the driver)."""
    try:
        log = spark.read.parquet(log_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise KeyError(f"alias not set: {alias}") from e
    r = log.where(F.col("alias") == alias).agg(F.max_by("version", F.struct("set_at", "seq")).alias("v")).first()
    if r is None or r["v"] is None:
        raise KeyError(f"alias not set: {alias}")
    return r["v"]


def has_alias(spark: SparkSession, log_path: str, alias: str) -> bool:
    """Whether an alias has been set (asked of Spark, so any shared path works)."""
    try:
        resolve_alias(spark, log_path, alias)
    except KeyError:
        return False
    return True


def score_batch(df: DataFrame, prep, model: PipelineModel, threshold: float, model_name: str,
                version: str, keep: Sequence[str], contract: V.Contract | None = None,
                run_id: str | None = None, alias: str | None = None, flow_run_id: str | None = None,
                generation_id: str | None = None) -> DataFrame:
    """M6: validate (whole batch) -> prepare -> score -> label -> lineage columns.

    The concrete version, the alias it was resolved from (``model_alias``, if one
    was) and ONE timestamp per run are stored, with the ids of the flow run and of
    the data generation where there are any.
    """
    if contract is not None:
        V.assert_valid(df, contract)
    x = prep.transform(df, keep=keep) if prep is not None else df
    scored = probability(model.transform(x))
    return scored.select(*keep, F.col("score").alias("probability"),
                         label_from_threshold("score", threshold).alias("label"),
                         F.lit(model_name).alias("model_name"), F.lit(version).alias("model_version"),
                         F.lit(alias).cast("string").alias("model_alias"),
                         F.lit(run_id or str(uuid.uuid4())).alias("batch_run_id"),
                         F.lit(flow_run_id).cast("string").alias("flow_run_id"),
                         F.lit(generation_id).cast("string").alias("generation_id"),
                         F.current_timestamp().alias("predicted_at"))


# ---------------------------------------------------------------- sink
def prediction_constraints() -> dict:
    """V6 rules of the predictions table."""
    return {"label_in_0_1": F.col("label").isin(0, 1),
            "probability_in_0_1": (F.col("probability") >= 0) & (F.col("probability") <= 1)}


def append_predictions(pred: DataFrame, path: str, source_table: str, constraints=None,
                       identity: tuple[str, str] | None = None) -> int:
    """All-or-nothing append; returns the rows written.

    The constraints (and, with ``identity``, that exactly one of two id columns is
    filled) are part of the write itself: the first bad row fails the job, and a
    failed job commits nothing.  The model runs once.  The write replaces only this
    run's partition, so a retry of the same ``batch_run_id`` cannot duplicate rows."""
    rules = dict(constraints or prediction_constraints())
    if identity:
        rules["one_identity"] = V.one_of_filled(*identity)
    seen = Observation()
    out = V.enforce_constraints(pred, rules).withColumn("source_table", F.lit(source_table)) \
        .observe(seen, F.count(F.lit(1)).alias("n"))
    try:
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("source_table", "batch_run_id").parquet(path))
    except Exception as e:
        if "constraint violated" in str(e):
            raise V.ContractError("prediction batch rejected: constraint violated") from e
        raise
    return seen.get["n"]


def sanity_check(scored: DataFrame, expected_rows: int, required: Sequence[str] = ("probability", "label")) -> dict:
    """V4: output columns, row count, NaN, +-inf, range [0, 1], labels in {0, 1}: one aggregate."""
    missing = [c for c in required if c not in scored.columns]
    if missing:
        return {"ok": False, "failures": [f"missing columns {missing}"]}
    p = F.col("probability")
    r = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.isnan(p).cast("int")).alias("nan"),
                   F.sum((p.isNull()).cast("int")).alias("null"),
                   F.sum((F.abs(p) == float("inf")).cast("int")).alias("inf"),
                   F.sum(((p < 0) | (p > 1)).cast("int")).alias("out_of_range"),
                   F.sum((~F.col("label").isin(0, 1)).cast("int")).alias("bad_label")).first().asDict()
    fails = [f"{k}={v}" for k, v in r.items() if k != "n" and v]
    if r["n"] != expected_rows:
        fails.append(f"rows={r['n']} expected {expected_rows}")
    return {"ok": not fails, "failures": fails}


def normalise_identity(df: DataFrame, uses_key: bool, id_col: str = "customer_id",
                       key_col: str = "customer_key") -> DataFrame:
    """Both identity columns exist and exactly one is filled (checked by ``one_of_filled``).

    ``uses_key``: the source identifies rows by the string key (else by the numeric id)."""
    if uses_key:
        out = df.withColumn(id_col, F.lit(None).cast("bigint")).withColumn(key_col, F.col(key_col).cast("string"))
    else:
        out = df.withColumn(key_col, F.lit(None).cast("string")).withColumn(id_col, F.col(id_col).cast("bigint"))
    return out


def per_version(pred: DataFrame, version: str = "model_version", prob: str = "probability") -> DataFrame:
    """Count and mean probability per model version."""
    return pred.groupBy(version).agg(F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_probability"))


def latest_with_features(predictions: DataFrame, raw: DataFrame, key: str, version: str, order: Sequence[str],
                         version_col: str = "model_version") -> DataFrame:
    """The newest stored prediction of the active version per key, with its raw
    features (a prediction of another version is not comparable)."""
    return latest(predictions.where(F.col(version_col) == version), [key], order).join(raw, key)


def cv_pr_auc(df: DataFrame, features: Sequence[str], estimator, label: str = "y", fold: str = "fold",
              resample=None) -> float:
    """M4: mean PR-AUC over the folds of ``df`` (``fold`` from ``sampling.kfold``).

    ``resample`` (class weights, ``smote``) is applied to the training part of each fold only.
    """
    folds = sorted(r[fold] for r in df.select(fold).distinct().collect())  # k numbers
    scores = [fold_score(df, features, estimator, k, label, fold, resample) for k in folds]
    return sum(scores) / len(scores)


def draw_params(space: Mapping, seed: int, trial: int) -> dict:
    """Parameters of one random trial (ranges as in ``search.draw_uniform``)."""
    rng = random.Random(f"{seed}:{trial}")
    return {name: draw_uniform(spec, rng) for name, spec in space.items()}


def random_search(df: DataFrame, features: Sequence[str], make: Callable[..., object], space: Mapping, trials: int = 100,
                  seed: int = 42, label: str = "y", fold: str = "fold", resample=None) -> DataFrame:
    """M5: seeded random search; one row per trial (trial, params as JSON, pr_auc, error).

    Every trial is a distributed M4 run over the same cached folds; the driver only
    holds the drawn parameters and one score per trial.  A trial whose parameters are
    refused is a row; any other error is raised.
    """
    df = df.persist()
    rows = []
    try:
        for t in range(trials):
            params = draw_params(space, seed, t)
            try:
                rows.append((t, json.dumps(params), cv_pr_auc(df, features, make(**params), label, fold, resample), None))
            except Exception as e:
                if not is_parameter_error(e):
                    raise
                rows.append((t, json.dumps(params), None, str(e)))
    finally:
        df.unpersist()
    return df.sparkSession.createDataFrame(rows, "trial int, params string, pr_auc double, error string")
