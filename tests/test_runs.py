"""Committed runs and their state, point-in-time joins, panes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scorewell.operators import latest as L
from scorewell.operators import monitor as MO
from scorewell.operators import runlog as RL

T0 = dt.datetime(2024, 1, 1)


def _predictions(spark, run, n=20):
    return spark.range(n).select(
        F.lit("lines").alias("source_table"), F.lit(f"v{run % 3}").alias("model_version"), (F.col("id") / n + run / 100).alias("probability"),
        (F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(run), F.lit(0), F.col("id"))).alias("predicted_at"), F.col("id").alias("row"))


def test_unpublished_runs_are_invisible(spark, tmp_path):
    """A run killed while it writes, and one killed before it is published, between two runs."""
    root = str(tmp_path / "runs")
    assert RL.manifest(spark, root).count() == 0
    first = RL.append_run(_predictions(spark, 0), root)
    with pytest.raises(Exception, match="boom"):
        RL.append_run(_predictions(spark, 1).withColumn("row", F.when(F.col("row") < 19, F.col("row")).otherwise(F.raise_error(F.lit("boom")))), root)
    RL.write_aside(_predictions(spark, 2), root, "rows", "half")  # nobody published it
    last = RL.append_run(_predictions(spark, 3), root, "mine")
    got = RL.read_runs(spark, root)
    assert last == "mine" and {r.run_id: r.n for r in got.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {first: 20, "mine": 20}
    RL.append_run(_predictions(spark, 3, 7), root, "mine")  # a retry replaces
    assert RL.read_runs(spark, root, run_ids=["mine"]).count() == 7 and RL.read_runs(spark, root).count() == 27


def test_state_equals_the_full_scan(spark, tmp_path):
    """After ten runs, one of them twice, and a run that was not published."""
    root = str(tmp_path / "runs")
    for run in range(10):
        RL.PREDICTIONS.append(_predictions(spark, run, 5 + run), root, f"run{run}")
    RL.PREDICTIONS.append(_predictions(spark, 4, 50), root, "run4")
    RL.write_aside(_predictions(spark, 1, 500), root, "rows", "lost")
    rows = RL.read_runs(spark, root)
    norm = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert norm(RL.PREDICTIONS.merged(spark, root)) == norm(RL.PREDICTIONS.of(rows))
    from scorewell.operators.models import per_version
    assert norm(RL.per_version(spark, root)) == norm(per_version(rows))
    now = T0 + dt.timedelta(days=1)
    assert norm(RL.staleness(spark, root, now)) == norm(L.staleness(rows, ["source_table"], "predicted_at", now))


def test_as_of_join_equals_a_loop(spark):
    """Ties, nulls on both sides, a hot key over many buckets, and left columns of any name."""
    rng = random.Random(4)
    t = lambda: T0 + dt.timedelta(minutes=rng.randrange(300))
    key = lambda: "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None])
    left = [(i, key(), t() if rng.random() < 0.95 else None, i) for i in range(900)]
    right = [(i, key(), t() if rng.random() < 0.95 else None, f"v{i}") for i in range(700)] + [(1000, "only", T0, "x")]
    ld = spark.createDataFrame(left, "id long, k string, at timestamp, _t long").repartition(4)
    rd = spark.createDataFrame(right, "rid long, k string, since timestamp, value string").repartition(4)
    got = L.as_of_join(ld, rd, ["k"], "at", ["since", "rid"], ["rid", "value"], per_bucket=150)
    assert got.columns == ["id", "k", "at", "_t", "rid", "value"]

    def want(k, at):
        seen = [(s, i, v) for i, q, s, v in right if q == k and k is not None and s is not None and at is not None and s <= at]
        return max(seen)[1:] if seen else (None, None)
    assert {r.id: (r.rid, r.value) for r in got.collect()} == {i: want(k, at) for i, k, at, _x in left}
    assert L.as_of_join(ld.where("id < 0"), rd, ["k"], "at", ["since", "rid"], ["rid"]).count() == 0
    assert L.as_of_join(ld, rd.where("rid < 0"), ["k"], "at", ["since", "rid"], ["rid"]).where("rid is null").count() == 900


def test_panes_move_fewer_rows(spark):
    """Sliding windows from panes equal Spark's own, without a copy of each row per window."""
    df = spark.range(5000).select((F.lit(T0) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 3)).alias("at"),
                                  F.when(F.col("id") % 7 == 0, None).otherwise(F.pmod(F.xxhash64("id"), F.lit(900))).cast("double").alias("ms"), (F.col("id") % 5 == 0).alias("bad"))
    plain = df.groupBy(F.window("at", "5 minutes", "1 minute").alias("w")).agg(F.count("*").alias("requests"), F.sum(F.col("bad").cast("bigint")).alias("errors"))
    want = {(r.s, r.requests, r.errors) for r in plain.select(F.col("w.start").alias("s"), "requests", "errors").collect()}
    assert {(r.window_start, r.requests, r.errors) for r in MO.error_rate(df, "at", F.col("bad")).collect()} == want
    p = MO.panes(df, "at", {}, {"requests": F.lit(1), "errors": F.col("bad").cast("bigint"), **MO.bucket_sums("ms")})
    full = {r.window_start: r for r in MO.request_windows(p).collect()}
    assert {(k, r.requests, r.errors) for k, r in full.items()} == want
    alone = {r.window_start: r for r in MO.latency_quantiles(df, "at", "ms").collect()}
    assert all(full[k].p95 == r.p95 and full[k].p50 == r.p50 for k, r in alone.items())
    assert "Expand" not in MO.error_rate(df, "at", F.col("bad"))._jdf.queryExecution().executedPlan().toString()


def test_staged_tables_can_be_removed(spark):
    import os
    from scorewell import session
    t = session.staged(spark.range(5), "five")
    folder = session.staging_dir(spark).removeprefix("file:")
    assert t.count() == 5 and any(f.startswith("five-") for f in os.listdir(folder))
    kept = sorted(os.listdir(folder))
    other = os.path.join(os.path.dirname(folder), "scorewell-staged-other")
    os.makedirs(other, exist_ok=True)
    if all(f.startswith("five-") for f in kept):  # alone in this session: nobody else reads staged tables
        session.clear_staged(spark)
        assert not os.path.exists(folder)
    assert os.path.exists(other)
