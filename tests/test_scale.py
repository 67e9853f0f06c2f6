"""Work that must not grow: passes over the input, columns in a shuffle, calls of a store."""

from __future__ import annotations

import json
import math
import threading

import numpy as np
from pyspark.sql import functions as F

from scorewell.operators import explain as E
from scorewell.operators import metrics as M
from scorewell.operators import models as MD
from scorewell.operators import neighbours as N
from scorewell.operators import smote as SM
from scorewell.operators.booster import (HistogramBooster, HistogramBoosterModel, Layout, advanced, best_splits, histograms, packed,
                                         split_gains)
from scorewell.operators.search import fit_pipeline
from scorewell.operators.trees import tree_attribution
from scorewell.plans import scoring_queries as SQ
from scorewell.plans import training_queries as T


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _counted(spark, df, column: str):
    """``df`` with a column that adds to the accumulator whenever a row is computed."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def look(x):
        seen.add(1)
        return x

    return df.withColumn(column, look.asNondeterministic()(column)), seen


def test_curve_scores_rows_once(spark):
    df, seen = _counted(spark, spark.range(200).selectExpr("'m' AS model", "cast(id % 2 AS int) AS y", "id % 50 / 50.0D AS score"), "score")
    pts = M.curve(df, ["model"])
    assert pts.count() == 50
    M.roc_auc(None, ["model"], points=pts).collect()
    M.average_precision(None, ["model"], points=pts).collect()
    assert seen.value == 200


def test_model_metadata_does_not_join_rows(spark):
    rows = [("a", y, s) for y, s in [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (0, float("nan")), (1, float("nan")), (1, None), (None, 0.5)]] * 5 \
        + [("b", 1, 0.3), ("b", 0, 0.2), (None, 1, 0.4), (None, 0, 0.6)]
    plain = spark.createDataFrame(rows, "model string, y int, score double")
    df, seen = _counted(spark, plain, "score")
    got = {r["model"]: r for r in MD.model_metadata(df).collect()}
    assert seen.value <= 2 * len(rows)  # the curve, and the scores it leaves out
    for m, r in got.items():
        con = M.confusion(plain.where(F.col("model").eqNullSafe(F.lit(m))), ["model"], r["threshold"]).first()
        assert all(r[c] == con[c] for c in ("tp", "fp", "tn", "fn", "precision", "recall", "f1", "specificity", "accuracy"))
    assert set(got) == {"a", "b", None} and got["a"]["n"] == 30


def test_permutation_shuffles_rows_once(spark, monkeypatch):
    df = spark.range(300).selectExpr("cast(id AS string) AS k", "cast(id % 3 = 0 AS int) AS y", "id % 7 * 1.0D AS a", "id % 11 * 1.0D AS b")
    asked = []
    monkeypatch.setattr(E, "average_precision", lambda d, *a, **k: asked.append(d) or M.average_precision(d, *a, **k))
    before = spark.conf.get("scorewell.rowsPerBucket")
    spark.conf.set("scorewell.rowsPerBucket", "40")
    try:
        out = E.permutation_importance(df, "k", "y", ["a", "b"], lambda d: d.withColumn("score", F.col("a") + 2 * F.col("b")), repeats=3)
        got = {r["feature"]: r["importance_mean"] for r in out.collect()}
        plan = _plan(asked[0])
    finally:
        spark.conf.set("scorewell.rowsPerBucket", before)
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    whole = E.permutation_importance(df, "k", "y", ["a", "b"], lambda d: d.withColumn("score", F.col("a") + 2 * F.col("b")), repeats=3)
    for r in whole.collect():  # the order of a repeat does not depend on its buckets
        assert math.isclose(got[r["feature"]], r["importance_mean"], abs_tol=1e-12)


def test_neighbours_meet_only_boxes_in_reach(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.floor(rng.uniform(0, 60, (5000, 3))), [[900.0, 900.0, 900.0]], rng.uniform(0, 1, (200, 3))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double")
    got = N.nearest_neighbours(df, "id", ["a", "b", "c"], 5, per_cell=300).collect()
    lists = {}
    for r in got:
        lists.setdefault(r["id"], []).append((r["rank"], r["neighbour"], round(r["distance"], 9)))
    for i in range(0, len(x), 37):
        d2 = ((x - x[i]) ** 2).sum(1)
        best = [j for j in np.lexsort((np.arange(len(x)), d2)) if j != i][:5]
        assert sorted(lists[i]) == [(n + 1, j, round(float(np.sqrt(d2[j])), 9)) for n, j in enumerate(best)]
    assert len(got) == 5 * len(x)
    # a query's block meets few of the other blocks
    q = np.unique(x, axis=0)
    row, _col, _d2, bound = N.near(q, np.full(len(q), np.inf), q, 5)
    assert len(row) < 40 * len(q) and np.isfinite(bound).all()


def test_ensemble_columns_equal_the_long_form(spark):
    rows = [("a", 1.0, 0.05, 0.02), ("b", 30.0, None, 0.07), ("b", 40.0, 0.01, 0.01), (None, 26.0, 0.04, None), ("c", None, None, None)]
    x = spark.createDataFrame(rows, "row_id string, l_quantity double, l_discount double, l_tax double")
    model, w, m = HistogramBoosterModel(json.dumps(T.FIXED_TREE)), dict.fromkeys(T.LINE_FEATURES, 0.5), dict.fromkeys(T.LINE_FEATURES, 0.1)
    long = E.ensemble_attribution({"t": tree_attribution(x, "row_id", T.LINE_FEATURES, model), "l": E.linear_attribution(x, "row_id", w, m)}, "row_id", {"t": 3.0, "l": 1.0})
    wide = E.linear_attribution(tree_attribution(x, "row_id", T.LINE_FEATURES, model, prefix="t_"), "row_id", w, m, prefix="l_")
    got = E.ensemble_columns(wide, "row_id", T.LINE_FEATURES, {"t_": 3.0, "l_": 1.0})
    key = lambda d: {(r.row_id, r.feature): None if r.phi is None else round(r.phi, 12) for r in d.collect()}
    assert key(got) == key(long) and got.count() == 12
    assert _plan(got).count("Exchange hashpartitioning") == 1 and "Union" not in _plan(got)


def test_correlation_counts_pairs_once(spark):
    df, seen = _counted(spark, spark.range(400).selectExpr("'k' AS k", "id % 20 * 1.0D AS x", "id * 37 % 101 * 1.0D AS y"), "x")
    out = M.spearman_pearson(df, ["k"], "x", "y")
    assert _plan(out).count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in _plan(out)
    assert out.first()["spearman"] is not None and seen.value == 400


def test_smote_does_not_lay_neighbours_out(spark, monkeypatch):
    """No written table of the interpolation has a row per neighbour."""
    df = spark.range(90).selectExpr("id", "cast(id % 7 AS double) AS a", "cast(id * id % 31 AS double) AS b", "cast(id < 30 AS int) AS y")
    sizes = {}

    def noted(d, name, real=SM.staged):
        out = real(d, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(SM, "staged", noted)
    new = SM.smote(df, "y", "id", ["a", "b"]).where("draw is not null")
    assert sorted(r.draw for r in new.collect()) == list(range(30))
    assert sizes and max(sizes.values()) == 30


def test_booster_level_moves_sums_once(spark):
    rows = spark.createDataFrame([(float(i % 3 == 0), 1.0, bytearray([i % 4, i % 5])) for i in range(60)], "y double, w double, b binary").repartition(3)
    gains = split_gains(histograms(rows, [], [{}], [0], 0.0, 2, 8))
    best = gains.groupBy("node").agg(F.max("gain").alias("g"))
    got = {(r.feature, r.bin): r.n_left for r in gains.collect()}
    assert got == {(f, b): float(sum(i % m <= b for i in range(60))) for f, m in ((0, 4), (1, 5)) for b in range(m - 1)}
    assert len(best.collect()) == 1 and "Exchange hashpartitioning" not in _plan(best)  # dealt by node: one node is one partition


def _forms(spark, n=240):
    return spark.range(n).selectExpr("id", "id % 12 * 1.0D AS a", "id % 5 * 1.0D AS b", "cast(id % 12 > 6 OR id % 5 = 0 AS int) AS y")


def test_models_score_rows_once(spark):
    df = _forms(spark)
    fitted = {n: fit_pipeline(df, ["a", "b"], e) for n, e in MD.estimators(trees=1).items()}
    valid, seen = _counted(spark, df, "a")
    got = MD.evaluate_models(fitted, valid, "vote")
    assert seen.value == 240 and list(got) == [*fitted, "vote"]
    for name, m in fitted.items():
        assert got[name] == MD.evaluate(MD.probability(m.transform(df)), name)
    plain = HistogramBooster(labelCol="y", maxIter=1).fit(fitted["logistic"].stages[0].transform(df))
    assert plain.transform(fitted["logistic"].stages[0].transform(df)).columns[-2:] == ["probability", "prediction"]


def test_model_that_cannot_score_is_a_row(spark):
    df = _forms(spark)
    fitted = {n: fit_pipeline(df, ["a", "b"], e) for n, e in MD.estimators(trees=1).items() if n in ("logistic", "histogram_trees")}

    class Broken:
        def transform(self, _df):
            return _df.withColumn("probability", F.raise_error(F.lit("no scores")))

    got = MD.evaluate_models(fitted | {"broken": Broken()}, df, "vote")
    assert got["broken"]["status"] == "failed" and got["broken"]["roc_auc"] is None
    assert {n: r["status"] for n, r in got.items() if n != "broken"} == {"logistic": "ok", "histogram_trees": "ok", "vote": "ok"}
    assert got["vote"] == MD.evaluate_models(fitted, df, "vote")["vote"]
    assert MD.evaluate_models({"broken": Broken()}, df, "vote")["broken"]["error"] and MD.evaluate_models({}, df, "vote") == {}


def test_train_score_fits_the_whole_family(spark, tmp_path, monkeypatch):
    flags, first = "RAN", "1-URGENT 2-HIGH 3-MEDIUM 4-NOT 5-LOW".split()
    spark.createDataFrame([(i, first[i % 5], "FO"[i % 2]) for i in range(60)], "o_orderkey bigint, o_orderpriority string, o_orderstatus string") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(i % 60, i // 60, i, i, 1.0 + i * 7 % 50, i % 11 / 100, i % 9 / 100, flags[i % 7 % 3], "FO"[i % 2]) for i in range(240)],
                          "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    asked = {}

    def noted(_spark, name, est, *_a):
        asked[name] = est
        return None, {"model": name, "status": "failed", "error": "not fitted", "roc_auc": None, "pr_auc": None, "f1": None, "recall": None, "precision": None}

    monkeypatch.setattr(MD, "train_evaluate", noted)
    rows = SQ.train_score(spark, str(tmp_path)).collect()
    assert len(rows) == 8 and sorted(asked) == sorted(f"{n}+{k}" for n in MD.estimators() for k in ("weight", "smote"))
    size = {"gradient_trees": ("maxIter", 20), "histogram_trees": ("maxIter", 20), "random_forest": ("numTrees", 40), "logistic": ("maxIter", 50)}
    for name, est in asked.items():
        param, n = size[name.split("+")[0]]
        assert est.getOrDefault(param) == n, name


def test_booster_blocks_hold_margins_and_best_splits(spark):
    bins, n = [32, 9, 2, 3, 32, 2], 400  # several features are counted together
    layout = Layout(bins, most=288)
    assert sorted(f for g in layout.groups for f in g) == list(range(6)) and len(layout.groups) < 6 and max(layout.cells) <= 288
    draw = np.random.default_rng(3)
    x = np.column_stack([draw.integers(0, b, n) for b in bins]).astype(np.uint8)
    y, w = (draw.random(n) < 0.2 + 0.02 * x[:, 0]).astype(float), draw.random(n) + 0.5
    binned = spark.createDataFrame([(float(a), float(b), bytearray(r.tobytes())) for a, b, r in zip(y, w, x)], "y double, w double, b binary").repartition(3)
    first = [{"feature": 0, "bin": 11, "left": 1, "right": 2}, {"value": -0.4}, {"feature": 3, "bin": 0, "left": 3, "right": 4}, {"value": 0.1}, {"value": 0.7}]
    growing = [{"feature": 4, "bin": 15, "left": 1, "right": 2}, {"value": 0.0}, {"value": 0.0}]
    blocks = advanced(packed(binned, layout, -0.3), first, layout)  # the tree is added once, not at every level after it
    got = {r["node"]: r for r in best_splits(blocks, growing, [1, 2], layout, 1.0, 1e-3).collect()}
    want = split_gains(histograms(binned, [first], growing, [1, 2], -0.3, 6, 32)).where("h_left >= 1e-3 AND h_right >= 1e-3").collect()
    for node in (1, 2):
        best = max((r for r in want if r["node"] == node), key=lambda r: (r["gain"], -r["feature"], -r["bin"]))
        assert (got[node]["feature"], got[node]["bin"], got[node]["n_left"]) == (best["feature"], best["bin"], best["n_left"])
        for c in ("gain", "g_left", "h_right", "g_all"):
            assert math.isclose(got[node][c], best[c], rel_tol=1e-9, abs_tol=1e-9)
    one = binned.where(F.col("b") == F.lit(bytearray(x[0].tobytes())))
    assert best_splits(packed(one, layout, 0.0), [{}], [0], layout, 1.0, 1e-3).collect() == []  # equal rows cannot be split


def test_family_is_fitted_side_by_side(spark, monkeypatch):
    df, all_there = _forms(spark), threading.Barrier(4, timeout=60)

    def fit(_spark, name, *_a):
        all_there.wait()  # breaks where one fit waits for another to end
        return None, {"model": name, "status": "failed", "error": "no", "roc_auc": None, "pr_auc": None, "f1": None, "recall": None, "precision": None}

    monkeypatch.setattr(MD, "train_evaluate", fit)
    monkeypatch.setattr(MD, "smote", lambda train, *_a: train)
    rows = [r["model"] for r in MD.train_family(df, df, ["a", "b"]).collect()]
    assert rows == [f"{n}+{k}" for k in ("weight", "smote") for n in MD.estimators()]
