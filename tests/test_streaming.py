"""Streams resume, repeat suppression over many firings, completed runs over batches."""

import datetime as dt
import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scorewell.streaming import jobs as J

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, series string, at timestamp, status string"


def _put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _collect(spark, out):
    return spark.read.parquet(out).collect()


def _writer(out):
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))


def test_stream_resumes_after_a_restart(spark):
    d = tempfile.mkdtemp(prefix="stream-")
    src, out = f"{d}/in", f"{d}/out"
    _put(spark, src, [(1, "a", T0, None)])
    for more in ([(2, "a", T0, None)], [(3, "b", T0, None)], None):
        J.run_available_now(J.file_stream(spark, src, spark.read.parquet(src).schema), "copy", out, _writer(out))
        if more:
            _put(spark, src, more)
    rows = _collect(spark, out)
    assert sorted(r["id"] for r in rows) == [1, 2, 3]  # none read twice
    assert sorted({r["batch_id"] for r in rows}) == [0, 1, 2]  # no batch overwritten


def test_repeat_suppression_over_many_chunks_and_batches(spark):
    """25,000 firings of one series in shuffled order: more than one Arrow chunk."""
    d = tempfile.mkdtemp(prefix="alerts-")
    src, out = f"{d}/in", f"{d}/out"
    rng = np.random.default_rng(1)
    us = np.sort(rng.choice(12 * 3600 * 10, 25_000, replace=False)) * 100_000
    want = J.sent_times(us, 3_600_000_000, None)
    slow, last = [], None  # the rule, one firing at a time
    for t in us.tolist():
        if last is None or t >= last + 3_600_000_000:
            slow.append(t)
            last = t
    assert want == slow
    half = int(np.searchsorted(us, 6 * 3600 * 1_000_000))
    for part in (us[:half], us[half:]):
        rows = [(int(i), "s", T0 + dt.timedelta(microseconds=int(t)), None) for i, t in enumerate(rng.permutation(part))]
        _put(spark, src, rows)
        n = J.notify_with_repeat(J.file_stream(spark, src, spark.read.parquet(src).schema).withColumn("rule", F.lit("r")),
                                 "rule", "series", "at", F.lit("pipeline"))
        J.run_available_now(n, "repeat", out, _writer(out))
    base = int(spark.range(1).select(F.unix_micros(F.lit(T0).cast("timestamp"))).first()[0])
    assert sorted(r["ts_us"] - base for r in _collect(spark, out)) == want


def test_completed_runs_over_late_rows(spark):
    """Seven runs of one stream: order by time whatever the arrival, completed ->
    completed does not fire, silence beyond the time to live does, later rows are lost."""
    d = tempfile.mkdtemp(prefix="runs-")
    src, out = f"{d}/in", f"{d}/out"
    hour = lambda k: T0 + dt.timedelta(hours=k)
    batches = [[(1, "g", hour(1), "completed"), (2, "h", hour(2), "completed")],
               [(3, "g", hour(0), "completed"), (4, "g", hour(0.5), "running"), (5, "h", hour(3), "failed")],   # late, in time
               [(6, "h", hour(4), "completed"), (7, "g", hour(4), None), (8, "g", hour(4.5), "completed")],
               [(9, "x", hour(20), "running")], [(10, "g", hour(5), "running"), (11, "g", hour(21), "completed")],  # 10 is too late
               [(12, "h", hour(40), "completed")], [(13, "x", hour(60), "running")]]
    for rows in batches:
        _put(spark, src, rows)
        done = J.completed_runs(J.file_stream(spark, src, spark.read.parquet(src).schema), "series", "status", "at", "id",
                                "3 hours", dt.timedelta(hours=24))
        J.score_completed_runs(done, "runs", out, _writer(out))
    got = sorted((r["generation_id"], (r["completed_us"] - int(T0.timestamp() * 1e6)) / 3.6e9) for r in _collect(spark, out))
    assert got == [("g", 0.0), ("g", 1.0), ("g", 4.5), ("h", 2.0), ("h", 4.0), ("h", 40.0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != J.ROCKSDB


def test_completed_runs_state_is_bounded(spark):
    """After a long silence no generation has state, however many there were."""
    d = tempfile.mkdtemp(prefix="runs-")
    src, out = f"{d}/in", f"{d}/out"
    for k in range(4):
        _put(spark, src, [(100 * k + i, f"g{k}-{i}", T0 + dt.timedelta(hours=10 * k), "completed") for i in range(30)])
        done = J.completed_runs(J.file_stream(spark, src, spark.read.parquet(src).schema), "series", "status", "at", "id",
                                "1 hour", dt.timedelta(hours=5))
        J.score_completed_runs(done, "bounded", out, _writer(out))
    state = spark.read.format("statestore").option("path", J.checkpoint_for(spark, "bounded", out)).option("stateVarName", "last").load()
    assert state.count() <= 30 and _collect(spark, out) and len(_collect(spark, out)) == 90


def test_completions_follow_gaps():
    import numpy as np
    at, done = np.array([10, 20, 500, 510]), np.array([True, True, True, False])
    assert J.completions(at, done, None, False, 100).tolist() == [True, False, True, False]
    assert J.completions(at, done, 5, True, 100).tolist() == [False, False, True, False]
    assert J.completions(at[:0], done[:0], 5, True, 100).tolist() == []


def test_snapshot_isolates_specs_and_skips_empty_results(spark):
    d = tempfile.mkdtemp(prefix="snap-")
    df = spark.createDataFrame([(1, "a", T0, None)], SCHEMA)
    status = J.snapshot_batch(df, {"ok": lambda b: b.groupBy("series").count(), "empty": lambda b: b.where("id > 5"),
                                   "bad": lambda b: b.select("missing")}, d, 3)
    assert status["ok"] == status["empty"] == "ok" and status["bad"].startswith("failed")
    assert os.path.exists(f"{d}/spec=ok/batch_id=3") and not os.path.exists(f"{d}/spec=empty")


def test_shared_folder_stays_the_same(spark):
    from scorewell.session import checkpoint_dir
    assert checkpoint_dir(spark) == checkpoint_dir(spark) == J.checkpoint_for(spark, "x", "y").split("/scorewell-streams")[0]


def test_generations_of_a_group_fold_alike():
    rng = np.random.default_rng(8)
    ready = pd.DataFrame({"generation_id": rng.choice(["a", "b", "c", None, "d"], 300), "ts_us": rng.integers(0, 2000, 300),
                          "seq": np.arange(300), "done": rng.random(300) < 0.6})
    last = pd.DataFrame({"generation_id": ["a", None, "z"], "ts_us": [-5, -90, 7], "done": [True, True, False]})
    none = pd.DataFrame({"generation_id": [], "ts_us": [], "done": []})
    for old in (last, none):
        fired, new = J._fold(ready, old, 40)
        want = set()
        for g in ("a", "b", "c", "d", None):
            mine = ready[ready["generation_id"].isna() if g is None else ready["generation_id"] == g].sort_values(["ts_us", "seq"])
            was = old[old["generation_id"].isna() if g is None else old["generation_id"] == g]
            at = mine["ts_us"].to_numpy()
            hit = J.completions(at, mine["done"].to_numpy(), *((int(was["ts_us"].iloc[0]), bool(was["done"].iloc[0])) if len(was) else (None, False)), 40)
            want |= {(g, int(t)) for t in at[hit]}
            end = new[new["generation_id"].isna() if g is None else new["generation_id"] == g]
            assert end["ts_us"].tolist() == [at[-1]] and end["done"].tolist() == [mine["done"].iloc[-1]]
        assert {(None if pd.isna(g) else g, int(t)) for g, t in fired.itertuples(index=False)} == want
        assert len(new) == 5 + ("z" in list(old["generation_id"]))
    assert all(len(x) == 0 for x in J._fold(ready[:0], none, 40))
