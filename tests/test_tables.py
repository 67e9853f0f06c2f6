"""Sources, sinks, registries and reports that no fixture query reaches."""

import json
import math

import pytest
from pyspark.sql import functions as F

from scorewell.functions import columns as C
from scorewell.operators import drift as D
from scorewell.operators import features as FE
from scorewell.operators import latest as L
from scorewell.operators import models as MD
from scorewell.operators import sampling as S
from scorewell.operators import validate as V
from scorewell.sources import io


def test_filtered_predictions_read_one_source(spark, tmp_path):
    path = str(tmp_path / "pred")
    df = spark.createDataFrame([(1, "a", "r1"), (2, "b", "r1"), (3, "a", "r2")], "id long, source_table string, batch_run_id string")
    df.write.partitionBy("source_table", "batch_run_id").parquet(path)
    got = io.filtered_predictions(spark, path, "a")
    assert {r.id for r in got.collect()} == {1, 3}
    assert "PartitionFilters: [isnotnull(source_table" in got._jdf.queryExecution().executedPlan().toString()


def test_override_json_replaces_a_feature(spark, tmp_path):
    path = tmp_path / "over.json"
    path.write_text(json.dumps({"x": [1, 2.5, 3], "y z": [9]}))
    over = D.read_override_json(spark, str(path))
    assert sorted((r.feature, float(r.num)) for r in over.collect()) == [("x", 1.0), ("x", 2.5), ("x", 3.0), ("y z", 9.0)]
    now = spark.createDataFrame([("x", "current", 7.0, None), ("w", "current", 8.0, None)], "feature string, side string, num double, cat string")
    got = {(r.feature, r.num) for r in D.override_values(now, over).collect()}
    assert got == {("w", 8.0), ("x", 1.0), ("x", 2.5), ("x", 3.0), ("y z", 9.0)}


def test_drift_results_are_checked_and_counted(spark, tmp_path):
    base = spark.createDataFrame([(float(i % 17), "ab"[i % 2]) for i in range(200)], "x double, c string")
    cur = spark.createDataFrame([(float(i % 17), "ab"[i % 2]) for i in range(90)] + [(None, None), (math.nan, "a")], "x double, c string")
    res = D.drift_check(base, cur, {"x": "numeric", "c": "categorical"})
    out = {r.feature: r for r in res.collect()}
    assert (out["x"].n_excluded_baseline, out["x"].n_excluded_current, out["x"].sample_size_current) == (0, 2, 90)
    assert (out["c"].n_excluded_current, out["c"].sample_size_current) == (1, 91) and out["x"].verdict == "pass"
    path = str(tmp_path / "results")
    D.append_results(res, path)
    D.append_results(res, path)
    assert spark.read.parquet(path).groupBy("feature").count().where("count = 2").count() == 2
    with pytest.raises(Exception, match="constraint violated"):
        D.append_results(res.withColumn("verdict", F.lit("unsure")), path)
    assert spark.read.parquet(path).count() == 4


def test_one_sort_gives_numpy_quantiles(spark):
    import numpy as np
    x = np.random.default_rng(3).integers(0, 60, 999).astype(float)
    long = spark.createDataFrame([("f", "baseline", float(v), None) for v in x], "feature string, side string, num double, cat string")
    assert D.quantile_edges(long) == {"f": pytest.approx(sorted(set(np.quantile(x, np.linspace(0, 1, 11)))))}


def test_table_rules(spark):
    runs = spark.createDataFrame([(5, 5, "completed"), (0, 0, "completed"), (100_001, 1, "failed"), (5, 6, "failed"), (5, 1, "paused"), (None, 1, "failed")],
                                 "requested_count int, inserted_count int, status string")
    r = V.constraint_counts(runs, V.generation_run_constraints()).first()
    assert (r.requested_count, r.inserted_count, r.status) == (3, 2, 1)
    with pytest.raises(Exception, match="constraint violated"):
        V.enforce_constraints(runs, V.generation_run_constraints()).collect()
    assert V.enforce_constraints(runs.limit(1), V.generation_run_constraints()).count() == 1


def test_preparation_checks(spark):
    before = spark.createDataFrame([(1,)], "a int")
    good = spark.createDataFrame([(-1.0, 0.3, 1, 1, 1, 0), (1.0, 0.0, 0, 1, 1, 1), (0.0, 0.2, 0, 0, 0, 1)], "tenure double, res double, t1 int, c1 int, senior int, added int")
    args = (["gone"], ["added"], ["t1"], ["c1"], "senior", "tenure", "res")
    assert all(V.preparation_checks(before, good, *args).values())
    bad = good.withColumn("gone", F.lit(1)).withColumn("tenure", F.col("tenure") + 1).withColumn("res", F.lit(0.0)).drop("c1")
    assert {k for k, v in V.preparation_checks(before, bad, *args).items() if not v} \
        == {"dropped_gone", "contract_dummies", "scaled_mean_near_zero", "residual_mostly_nonzero"}


def test_labels_weights_latest_and_regressions(spark):
    m = spark.range(1).select(C.project_labels(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), ["b", "z"]).alias("m")).first().m
    assert m == {"b": "2"}
    y = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "y int")
    assert S.positive_weight(y, "y") == 3.0 and S.positive_weight(y.where("y = 0"), "y") == math.inf
    runs = spark.createDataFrame([("k", i, i * 10) for i in range(9)] + [("j", 1, 5), (None, 4, 4), (None, 3, 3)], "k string, t int, v int")
    got = L.latest_n(runs, ["k"], ["t", "v"], 2).collect()
    assert sorted((str(r.k), r.t) for r in got) == [("None", 3), ("None", 4), ("j", 1), ("k", 7), ("k", 8)]
    a = spark.createDataFrame([("m", 0.7, 0.8, 0.5), ("n", 0.6, 0.7, 0.4)], "model string, pr_auc double, recall double, f1 double")
    b = spark.createDataFrame([("m", 0.75, 0.8, 0.4)], "model string, pr_auc double, recall double, f1 double")
    r = MD.regression_report(a, b).collect()
    assert len(r) == 1 and r[0].pr_auc_diff == pytest.approx(-0.05) and r[0].pr_auc_regressed and not r[0].recall_regressed and not r[0].f1_regressed


def test_categories_are_counted_exactly(spark):
    df = spark.range(1500).select(F.concat(F.lit("v"), F.col("id") % 1000).alias("c"), F.when(F.col("id") > 700, F.lit("x")).alias("d"))
    assert len(FE.fit_one_hot(df, ["c", "d"], 1000)["c"]) == 1000 and FE.fit_one_hot(df, ["d"])["d"] == ["x"]
    with pytest.raises(ValueError, match="'c': 1000"):
        FE.fit_one_hot(df, ["c"], 999)
    index = FE.fit_category_index(df, "c")
    out = FE.transform_category_index(df.unionByName(spark.createDataFrame([("new", None), (None, None)], "c string, d string")), "c", index)
    assert sorted(r["index"] for r in index.collect()) == list(range(1000))
    assert out.count() == 1502 and out.where("c_index is null").count() == 2 and out.select("c", "c_index").distinct().count() == 1002
    lost = FE.unmapped_counts(spark.createDataFrame([("Yes", "a"), ("No", None), ("maybe", "Yes"), (None, "No")], "p string, q string"), ["p", "q", "r"], {"Yes": 1, "No": 0})
    assert {r.column: r.n_unmapped for r in lost.collect()} == {"p": 1, "q": 1}


def test_versions_are_listed(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from scorewell.operators.booster import HistogramBoosterModel
    root = str(tmp_path / "models")
    assert MD.model_versions(spark, root).count() == 0
    scorer = HistogramBoosterModel(json.dumps({"base": 0.0, "cuts": [[]], "trees": []}))
    scorer._set(featuresCol="features")
    model = PipelineModel([VectorAssembler(inputCols=["x"], outputCol="features"), scorer])
    for version, t in (("v1", 0.4), ("v2", 0.5), ("v1", 0.6)):
        MD.save_bundle(root, version, None, model, t)
    assert {(r.version, r.threshold, r.kind) for r in MD.model_versions(spark, root).collect()} \
        == {("v1", 0.6, "HistogramBoosterModel"), ("v2", 0.5, "HistogramBoosterModel")}
    prep, again, t = MD.load_bundle(root, "v1")
    assert prep is None and t == 0.6 and again.transform(spark.createDataFrame([(1.0,)], "x double")).first().probability[1] == 0.5
