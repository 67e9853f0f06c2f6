"""Latest-per-key, replay, change events and gaps.

``latest`` is a ``max_by`` aggregate, so every map task pre-reduces a hot key
to one row before the shuffle.  Order-dependent row pairs (``lag``) use pinned
time buckets: the window runs per ``(key, bucket)`` and only the first row of
each bucket looks up the last row of the previous bucket, so no key is ever
processed by a single task as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewell.operators.ordered import BUCKET, bucket_of, null_safe_join, pinned_splits


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """K1: the newest row per key; ``order`` = (time, tie-break...) — a tie-break is required."""
    if len(order) < 2:
        raise ValueError("latest() needs a tie-break column after the time column")
    cols = [c for c in (cols or df.columns) if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return g.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def as_of(df: DataFrame, keys: Sequence[str], order: Sequence[str], at, cols=None) -> DataFrame:
    """K2: the state of every key as of time ``at`` (K1 after ``time <= at``)."""
    return latest(df.where(F.col(order[0]) <= F.lit(at).cast(dict(df.dtypes)[order[0]])), keys, order, cols)


def latest_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """K3: newest ``n`` rows per key (``WindowGroupLimit`` trims each map task to n rows per key)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def _order_value(df: DataFrame, col: str) -> Column:
    t = dict(df.dtypes)[col]
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(F.col(col)).cast("double")
    return F.col(col).cast("double")


def with_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                  prefix: str = "prev_", per_bucket: int | None = None) -> DataFrame:
    """``lag`` of ``cols`` along ``order`` within each key, skew-safe.

    Time is cut into pinned global buckets; ``lag`` runs per (key, bucket); the
    first row of a bucket takes the last row of the key's previous non-empty
    bucket from a ``(key, bucket)`` table (at most ``#keys x #buckets`` rows).
    """
    ov = _order_value(df, order[0])
    b = df.withColumn(BUCKET, bucket_of(ov, pinned_splits(df, ov, per_bucket)))
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    lagged = b.select("*", *[F.lag(c).over(w).alias(f"{prefix}{c}") for c in cols],
                      (F.row_number().over(w) == 1).alias("_first"))
    last = b.groupBy(*keys, BUCKET).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    wb = Window.partitionBy(*keys).orderBy(BUCKET)
    bound = last.select(*keys, BUCKET, F.lag("_last").over(wb).alias("_before"))
    j = null_safe_join(lagged, bound, [*keys, BUCKET], "left")
    out = j.select(*df.columns, *[F.when(F.col("_first"), F.col(f"_before.{c}")).otherwise(F.col(f"{prefix}{c}"))
                                  .alias(f"{prefix}{c}") for c in cols])
    return out


def as_of_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_order: Sequence[str],
               cols: Sequence[str], prefix: str = "", per_bucket: int | None = None) -> DataFrame:
    """K2 / J6, point in time: every left row with the ``cols`` of its key's newest right row
    at or before its time (``right_order`` = time, tie-break...); null where there is none.

    Both sides are one sequence per key.  Time is cut into pinned buckets shared by all
    keys; within a (key, bucket) the last right row is carried forward, and the last of
    the buckets before comes from a ``(key, bucket)`` table, so a key of any size is
    spread.  Rows with a null key or time match nothing.
    """
    keys = list(keys)
    t = _order_value(right, right_order[0])
    sound = lambda c: reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c])
    own, tie = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_l"), F.struct(*[F.col(c) for c in right_order]).alias("_o")
    payload = F.struct(*[F.col(c) for c in cols]).alias("_r")
    none = lambda c, df: F.lit(None).cast(df.select(c).schema[0].dataType)
    seen = right.where(sound([*keys, right_order[0]])).select(
        *keys, t.alias("_t"), F.lit(0).alias("_side"), none(own, left).alias("_l"), tie, payload)
    asks = left.where(sound([*keys, left_time])).select(
        *keys, _order_value(left, left_time).alias("_t"), F.lit(1).alias("_side"), own, none(tie, right).alias("_o"), none(payload, right).alias("_r"))
    both = seen.unionByName(asks)
    b = both.withColumn(BUCKET, bucket_of("_t", pinned_splits(both, "_t", per_bucket)))
    here = Window.partitionBy(*keys, BUCKET).orderBy("_t", "_side", "_o").rowsBetween(Window.unboundedPreceding, 0)
    ends = b.where("_side = 0").groupBy(*keys, BUCKET).agg(F.max_by("_r", F.struct("_t", "_o")).alias("_end"))
    every = b.select(*keys, BUCKET).distinct().join(ends, [*keys, BUCKET], "left")
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select(*keys, BUCKET, F.last("_end", ignorenulls=True).over(before).alias("_before"))
    j = b.withColumn("_here", F.last("_r", ignorenulls=True).over(here)).where("_side = 1").join(carried, [*keys, BUCKET])
    met = j.select("_l", F.coalesce("_here", "_before").alias("_m"))
    alone = left.where(~sound([*keys, left_time])).select(own, none(payload, right).alias("_m"))
    return met.unionByName(alone).select("_l.*", *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in cols])


def becomes(df: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, value) -> DataFrame:
    """K8: rows where ``status`` becomes ``value`` (the first row counts; value -> value does not)."""
    p = with_previous(df, keys, order, [status])
    return p.where((F.col(status) == F.lit(value)) & ~F.col(f"prev_{status}").eqNullSafe(F.lit(value))).drop(
        f"prev_{status}")


def largest_gap(df: DataFrame, keys: Sequence[str], time_col: str, tie: str) -> DataFrame:
    """Largest gap in seconds between consecutive times per key, and the number of rows."""
    p = with_previous(df, keys, [time_col, tie], [time_col])
    gap = (F.unix_micros(F.col(time_col).cast("timestamp"))
           - F.unix_micros(F.col(f"prev_{time_col}").cast("timestamp"))) / 1e6
    return p.groupBy(*keys).agg(F.max(gap).alias("max_gap_s"), F.count(F.lit(1)).alias("n"))


def staleness(df: DataFrame, keys: Sequence[str], time_col: str, now) -> DataFrame:
    """``now - max(time)`` in seconds per key; ``now`` is a parameter."""
    now_c = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    return df.groupBy(*keys).agg(
        ((F.unix_micros(now_c) - F.max(F.unix_micros(F.col(time_col).cast("timestamp")))) / 1e6)
        .alias("staleness_s"))


def time_range(df: DataFrame, time_col: str, start, end) -> DataFrame:
    """K9: rows with ``start <= time < end`` (pushed to the scan), ordered by time."""
    t = dict(df.dtypes)[time_col]
    return df.where((F.col(time_col) >= F.lit(start).cast(t)) & (F.col(time_col) < F.lit(end).cast(t))).orderBy(time_col)
