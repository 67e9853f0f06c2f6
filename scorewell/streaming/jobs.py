"""Structured Streaming jobs.

The reference polls; here the same work runs as streaming queries:

* ``request_panes``: watermarked one-minute panes of a request stream, from which
  sliding rates, error shares and latency quantiles are finished (T1-T3).
* ``notify_with_repeat``: alert routing with repeat suppression (T7), a
  stateful ``applyInPandasWithState`` whose state is one timestamp per key and
  expires with the repeat interval.
* ``score_stream``: per-record scoring with a dead-letter sink (T9, V2); each
  micro-batch is written once per batch id, so a retried batch overwrites its
  own output.
* ``VersionedScorer``: alias lookup per micro-batch, reload only when the
  version changes, keep the old model when loading fails (T10).
* ``snapshot_batch``: every metric spec in its own try block, appended per
  micro-batch (T4, S15).
* ``completed_runs`` / ``score_completed_runs``: event-driven scoring of runs that
  become completed (T8); ``transformWithState`` with timers: statuses held until the
  watermark, the last status per generation until its time to live.

Checkpoints live under the session's ``spark.checkpoint.dir``, at a name made of
the job and its sink: the same job on the same sink resumes where it stopped,
and a batch id is never used for two inputs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupStateTimeout

from scorewell.operators import monitor as MO
from scorewell.operators import validate as V
from scorewell.session import shared_path

# Repeat intervals of the notification routes.
REPEAT_INTERVAL = {"drift": dt.timedelta(hours=4), "pipeline": dt.timedelta(hours=1)}


def checkpoint_for(spark: SparkSession, name: str, sink: str) -> str:
    """The checkpoint of one job on one sink."""
    return shared_path(spark, "scorewell-streams", f"{name}-{hashlib.sha256(sink.encode()).hexdigest()[:24]}")


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Stream of a Parquet file or folder; named as a pattern of its parent, so both
    work and no local file access is needed."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    r = spark.readStream.format("parquet").schema(schema).option("basePath", parent)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(f"{parent}/{{{name}}}")


def run_available_now(df: DataFrame, name: str, sink: str, batch_fn: Callable[[DataFrame, int], None],
                      mode: str = "append") -> None:
    """Process everything new with ``foreachBatch``, then stop; ``sink`` names the
    output and with it the checkpoint."""
    q = (df.writeStream.outputMode(mode).trigger(availableNow=True)
         .option("checkpointLocation", checkpoint_for(df.sparkSession, name, sink))
         .foreachBatch(batch_fn).start())
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


# ---------------------------------------------------------------- T1-T3
def request_panes(stream: DataFrame, time_col: str, is_error: Column, latency: str, watermark: str = "10 minutes") -> DataFrame:
    """Requests, errors and latency buckets per one-minute pane, for update mode; the
    newest row of each pane gives ``MO.request_windows`` rates, shares and quantiles."""
    return MO.panes(stream.withWatermark(time_col, watermark), time_col, {},
                    {"requests": F.lit(1), "errors": is_error.cast("bigint"), **MO.bucket_sums(latency)})


def newest_panes(written: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The last state of each pane from an update-mode sink."""
    cols = [c for c in written.columns if c not in ("pane", batch)]
    return written.groupBy("pane").agg(F.max_by(F.struct(*cols), F.col(batch)).alias("x")).select("pane", "x.*")


# ---------------------------------------------------------------- T7
def sent_times(times: np.ndarray, interval: int, last: int | None) -> list[int]:
    """Of ascending firing times, those that are sent: the first, then each first one
    at least ``interval`` after the one sent before."""
    out = []
    i = 0 if last is None else int(np.searchsorted(times, last + interval))
    while i < len(times):
        out.append(int(times[i]))
        i = int(np.searchsorted(times, out[-1] + interval))
    return out


def _fold_notifications(key, pdfs: Iterator[pd.DataFrame], state):
    if state.hasTimedOut:  # nothing sent for a whole interval: the next firing is sent anyway
        state.remove()
        yield pd.DataFrame({"rule": [], "series": [], "ts_us": []})
        return
    interval = int(REPEAT_INTERVAL.get(key[2], dt.timedelta(hours=1)).total_seconds() * 1_000_000)
    # a group's rows come in chunks of any order: gather its times, then sort once
    times = np.sort(np.concatenate([p["ts_us"].to_numpy(np.int64) for p in pdfs]))
    last = state.get[0] if state.exists else None
    out = sent_times(times, interval, last)
    last = out[-1] if out else last
    state.update((last,))
    state.setTimeoutTimestamp(max((last + interval) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame({"rule": [key[0]] * len(out), "series": [key[1]] * len(out), "ts_us": out})


def notify_with_repeat(firings: DataFrame, rule: str, series: str, time_col: str, route: Column,
                       watermark: str = "1 day") -> DataFrame:
    """A firing is sent when nothing was sent for the same (rule, series, route)
    within the route's repeat interval.

    State per key: the last sent time, dropped when the watermark passes its
    interval.  Firings later than the watermark are not considered.
    """
    f = firings.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", watermark).select(
        F.col(rule).alias("rule"), F.col(series).cast("string").alias("series"), route.alias("route"),
        F.unix_micros("_at").alias("ts_us"), "_at")
    return f.groupBy("rule", "series", "route").applyInPandasWithState(
        _fold_notifications, "rule string, series string, ts_us long", "last_sent long", "append",
        GroupStateTimeout.EventTimeTimeout)


# ---------------------------------------------------------------- T9 / V2
def score_and_route(batch: DataFrame, contract: V.Contract, score: Column, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Valid rows get a score; invalid rows never reach the scorer and carry code + message."""
    v = V.violations(batch, contract)
    good = v.where(F.size(V.VIOLATIONS) == 0).select(*keep, score.alias("score"))
    first = F.element_at(F.col(V.VIOLATIONS), 1)
    bad = v.where(F.size(V.VIOLATIONS) > 0).select(
        *keep, first["rule"].alias("code"),
        F.concat_ws("; ", F.transform(V.VIOLATIONS, lambda x: F.concat_ws(":", x["column"], x["rule"])))
        .alias("message"))
    return good, bad


def score_stream(stream: DataFrame, contract: V.Contract, score: Column, keep: Sequence[str],
                 out_dir: str, name: str = "score") -> None:
    """Micro-batches scored into ``out_dir/scored``, rejects into ``out_dir/dead_letter``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        good, bad = score_and_route(batch, contract, score, keep)
        good.write.mode("overwrite").parquet(os.path.join(out_dir, "scored", f"batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(os.path.join(out_dir, "dead_letter", f"batch_id={batch_id}"))
    run_available_now(stream, name, out_dir, handle)


# ---------------------------------------------------------------- T10
class VersionedScorer:
    """Keeps the loaded model for the alias' current version."""

    def __init__(self, resolve: Callable[[], str], load: Callable[[str], object]):
        self.resolve, self.load = resolve, load
        self.version: str | None = None
        self.model = None
        self.reloads = 0

    def current(self):
        try:
            v = self.resolve()
        except Exception:  # noqa: BLE001 - keep serving the old version
            return self.version, self.model
        if v != self.version:
            try:
                m = self.load(v)
            except Exception:  # noqa: BLE001 - a failed load keeps the old model
                return self.version, self.model
            self.version, self.model = v, m
            self.reloads += 1
        return self.version, self.model


# ---------------------------------------------------------------- T4 / S15
def snapshot_batch(batch: DataFrame, specs: Mapping[str, Callable[[DataFrame], DataFrame]], path: str,
                   batch_id: int) -> dict:
    """Evaluate every spec on the micro-batch; one failing spec does not stop the others.
    An empty result writes nothing and is not an error."""
    status = {}
    batch = batch.persist()  # every spec reads it
    for name, fn in specs.items():
        try:
            rows = fn(batch).persist()
            if not rows.isEmpty():
                rows.write.mode("overwrite").parquet(os.path.join(path, f"spec={name}", f"batch_id={batch_id}"))
            rows.unpersist()
            status[name] = "ok"
        except Exception as e:  # noqa: BLE001 - isolated per spec
            status[name] = f"failed: {e}"
    batch.unpersist()
    return status


# ---------------------------------------------------------------- T8
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def completions(at: np.ndarray, done: np.ndarray, last_at: int | None, last_done: bool, ttl: int) -> np.ndarray:
    """Of a generation's rows in order, those that become completed: completed while the
    row before was not, or is more than ``ttl`` older, or there is none."""
    if not len(at):
        return np.zeros(0, bool)
    before = np.concatenate([[last_done], done[:-1]])
    gap = np.diff(np.concatenate([[at[0] if last_at is None else last_at], at]))
    return done & ~(before & (gap <= ttl))


_HELD = pa.schema([("generation_id", pa.string()), ("ts_us", pa.int64()), ("seq", pa.int64()), ("done", pa.bool_())])
_LAST = pa.schema([("generation_id", pa.string()), ("ts_us", pa.int64()), ("done", pa.bool_())])


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_pandas(rows, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(parts: list[bytes], schema: pa.Schema) -> pd.DataFrame:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(p).read_all() for p in parts)]).to_pandas()


def _fold(ready: pd.DataFrame, last: pd.DataFrame, ttl: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(completions, last statuses) of several generations' ``ready`` rows: ``completions``
    generation by generation, after its last status."""
    rows = pd.concat([last.assign(seq=-1, old=0), ready.assign(old=1)], ignore_index=True)
    code = pd.factorize(rows["generation_id"], use_na_sentinel=False)[0]
    at, done, old = rows["ts_us"].to_numpy(np.int64), rows["done"].to_numpy(bool), rows["old"].to_numpy() == 0
    by = np.lexsort((done, rows["seq"].to_numpy(np.int64), at, ~old, code))
    code, at, done, old = code[by], at[by], done[by], old[by]
    begin = np.diff(code, prepend=-1) != 0
    # a generation without a last status begins as one whose row before was not completed
    before = np.roll(done, 1) & ~begin
    fired = done & ~(before & (at - np.roll(at, 1) <= ttl)) & ~old
    ends = np.flatnonzero(np.roll(begin, -1))
    names = rows["generation_id"].to_numpy(object)[by]
    return (pd.DataFrame({"generation_id": names[fired], "completed_us": at[fired]}),
            pd.DataFrame({"generation_id": names[ends], "ts_us": at[ends], "done": done[ends]}))


class _CompletedRuns(StatefulProcessor):
    """Rows of a group of generations are held until the watermark passes them, then
    folded per generation in order of time and ``seq``; a last status is dropped when
    nothing came for ``ttl``.  State is Arrow data, so a batch costs a group a few calls of
    the store, however many generations and rows it has."""

    def __init__(self, ttl_us: int):
        self.ttl = ttl_us

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "rows binary")
        self.held = handle.getListState("held", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows))
        new = new.assign(done=new["status"] == "completed")
        self.held.appendValue((_packed(new[_HELD.names], _HELD),))
        self.handle.registerTimer(int(new["ts_us"].min() // 1000 + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        held = _unpacked([bytes(r[0]) for r in self.held.get()], _HELD)
        last = _unpacked([bytes(self.last.get()[0])] if self.last.exists() else [], _LAST)
        go = held["ts_us"] // 1000 < passed
        wait = held[~go]
        fired, last = _fold(held[go], last, self.ttl)
        if go.any():
            self.held.clear()
            if len(wait):
                self.held.appendValue((_packed(wait, _HELD),))
        ends = (last["ts_us"] + self.ttl) // 1000 + 1
        last, ends = last[ends >= passed], ends[ends >= passed]
        if len(last):
            self.last.update((_packed(last, _LAST),))
        else:
            self.last.clear()
        if len(wait):
            self.handle.registerTimer(int(wait["ts_us"].min() // 1000 + 1))
        elif len(last):
            self.handle.registerTimer(int(ends.min()))
        if len(fired):
            yield fired

    def close(self) -> None:
        pass


def completed_runs(runs: DataFrame, generation: str, status: str, time_col: str, seq: str, watermark: str = "1 hour",
                   ttl: dt.timedelta = dt.timedelta(days=30), groups: int = 1024) -> DataFrame:
    """One row each time a run *becomes* completed (K8 on a stream).

    Statuses may come in any order across micro-batches: they are held until the
    watermark has passed them, and only rows later than the watermark are lost.  State,
    in ``groups`` groups by the generation's hash: the rows held and each last status,
    which is dropped when the generation was silent for ``ttl`` (a later ``completed``
    then fires again).  Start
    the query with the RocksDB state store (``score_completed_runs`` does).
    """
    r = runs.withColumn("_at", F.col(time_col).cast("timestamp")).withWatermark("_at", watermark).select(
        F.col(generation).cast("string").alias("generation_id"), F.col(status).alias("status"),
        F.unix_micros("_at").alias("ts_us"), F.col(seq).cast("long").alias("seq"), "_at")
    r = r.withColumn("_group", F.pmod(F.xxhash64("generation_id"), F.lit(groups)).cast("int"))
    return r.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_CompletedRuns(ttl // dt.timedelta(microseconds=1)), outputStructType="generation_id string, completed_us long",
        outputMode="append", timeMode="EventTime")


def score_completed_runs(completed: DataFrame, name: str, sink: str,
                         on_generations: Callable[[DataFrame, int], None]) -> None:
    """Hand each micro-batch of newly completed runs to ``on_generations`` as a
    DataFrame: the handler reads their rows by a semi join (S2), scores (M6) and
    appends (S11) them all in one job.  It must be idempotent per batch id."""
    conf, key = completed.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, ROCKSDB)  # lists and timers need it; read when the query starts
    try:
        run_available_now(completed, name, sink, on_generations)
    finally:
        conf.set(key, before) if before else conf.unset(key)
