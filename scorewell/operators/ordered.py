"""Global order without a single-partition window.

ROC/PR curves, KS, mid-ranks, rank-picked percentiles, exact quantiles and
hash positions all need running totals along an order.  ``Window.orderBy``
without a partition moves every row to one task, and ``partitionBy(key)``
still sends a hot key to one task.  Here:

1. the caller reduces first (``groupBy(key, value)`` counts; ties collapse);
2. the order is cut into ``ceil(rows / rows_per_bucket)`` buckets of about equal
   row numbers, over all keys together, so a key of any size is spread as widely
   as its rows are.  The cut points are pinned (collected once), so a recomputed
   stage buckets rows identically; their accuracy only affects balance, never
   the result.  Hash orders need no cut points: the hash's top bits are the bucket;
3. bucket totals give running offsets on a (key, bucket) table;
4. a window over (key, bucket) adds the offset.

All joins on keys are null-safe: rows with a null key form a group of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
ROWS_PER_BUCKET = 2_000_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the keys appear once, from the left."""
    if not keys:
        return left.join(right, F.lit(True), how)  # the right side is one row of totals
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_totals(df: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Adds per-key totals (``{name: column to sum}``) by a join; Spark picks a
    broadcast only where the totals are small by its own measure."""
    t = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return null_safe_join(df, t, keys)


def join_sized(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, share: int = 1024) -> DataFrame:
    """Inner join of rows with one row per group, no group in one task.

    ``size`` counts a group's rows.  Groups over ``1 / share`` of all rows are fewer
    than ``share``: they are broadcast.  No other key is large.
    """
    keys = list(keys)
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * share > total
    few = F.broadcast(groups.where(hot))
    cold = rows.join(F.broadcast(groups.where(hot).select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(cold.join(groups.where(~hot), keys)).drop(size)


def rows_per_bucket(df: DataFrame, given: int | None = None) -> int:
    """The bucket size: the argument, else ``scorewell.rowsPerBucket``, else the default."""
    return given or int(df.sparkSession.conf.get("scorewell.rowsPerBucket", str(ROWS_PER_BUCKET)))


def pinned_splits(df: DataFrame, value: str | Column, per_bucket: int | None = None) -> list[float]:
    """Cut points of ``value`` that leave about ``per_bucket`` rows in a bucket
    (one number per bucket reaches the driver; no job but a count where one bucket is enough)."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    want = math.ceil(df.count() / rows_per_bucket(df, per_bucket))
    if want <= 1:
        return []
    got = df.agg(F.approx_percentile(v, [i / want for i in range(1, want)], max(10_000, 10 * want)).alias("s")).first()["s"] or []
    return sorted({x for x in got if x is not None and not math.isnan(x)})


def bucket_of(value: str | Column, splits: Sequence[float]) -> Column:
    """Number of cut points strictly below the value (monotone in the value), by
    binary search over the pinned points."""
    if not splits:
        return F.lit(0)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    top = 1 << (len(splits).bit_length() - 1)
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])
    points = F.array(*[F.lit(float(x)) for x in splits])

    def go(at: Column, step: Column) -> Column:
        return at + F.when(F.coalesce(F.get(points, at + step - 1) < v, F.lit(False)), step).otherwise(F.lit(0))

    return F.aggregate(steps, F.lit(0), go)


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str],
                   descending: bool = False, splits: Sequence[float] | None = None, prefix: str = "cum_",
                   bucket: Column | None = None, per_bucket: int | None = None) -> DataFrame:
    """Inclusive running sums of ``sums`` along ``order`` within each key.

    ``df`` must have unique ``(keys, order)`` rows (reduce with ``groupBy``
    first).  The leading order column must be numeric, without nulls, unless a
    ``bucket`` column monotone in the order is given.  Adds ``cum_<col>``.
    """
    if bucket is None:
        lead = F.col(order[0]).cast("double")
        lead = -lead if descending else lead
        bucket = bucket_of(lead, pinned_splits(df, lead, per_bucket) if splits is None else splits)
    b = df.withColumn(BUCKET, bucket)
    tot = b.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    wk = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*keys, BUCKET, *[F.coalesce(F.sum(f"_t_{c}").over(wk), F.lit(0)).alias(f"_o_{c}")
                                       for c in sums])
    j = null_safe_join(b, offs, [*keys, BUCKET])
    ords = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    w = Window.partitionBy(*keys, BUCKET).orderBy(*ords).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(*[c for c in df.columns],
                    *[(F.sum(c).over(w) + F.col(f"_o_{c}")).alias(f"{prefix}{c}") for c in sums])


def value_ranks(counts: DataFrame, keys: Sequence[str], value: str, count_col: str, out: str) -> DataFrame:
    """Average rank (1-based, ties averaged) of each distinct value of a count table."""
    rt = running_totals(counts.where(F.col(value).isNotNull()), keys, [value], [count_col])
    return rt.select(*keys, value, (F.col(f"cum_{count_col}") - (F.col(count_col) - 1) / 2.0).alias(out))


def mid_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """K7: average rank (1-based, ties averaged) of every row's ``value`` within its
    key; null for a null value.

    Reduces to distinct values, runs the running count, joins back on (key, value).
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return null_safe_join(df, value_ranks(counts, keys, value, "_n", out), [*keys, value], "left")


def pick_by_rank(counts: DataFrame, keys: Sequence[str], value: str, count_col: str,
                 targets: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Value at 0-based position ``pos`` of the sorted values of each key.

    ``counts``: (keys, value, count) with unique (keys, value).  ``targets`` gives
    the named positions from a key's total ``n``.  Every distinct value knows its
    position range ``[cum - n, cum - 1]`` and keeps the targets that fall inside
    it.  Columns: keys, name, pos, n (the key's total), value.
    """
    rt = running_totals(counts, keys, [value], [count_col])
    rt = with_totals(rt, keys, {"_total": F.col(count_col)})
    lo, hi = F.col(f"cum_{count_col}") - F.col(count_col), F.col(f"cum_{count_col}") - 1
    named = F.array(*[F.struct(F.lit(name).alias("name"), pos.cast("bigint").alias("pos"))
                      for name, pos in targets(F.col("_total")).items()])
    hits = F.filter(named, lambda t: (t["pos"] >= lo) & (t["pos"] <= hi))
    return rt.select(*keys, value, F.col("_total").alias("n"), F.explode(hits).alias("_t")) \
        .select(*keys, F.col("_t.name").alias("name"), F.col("_t.pos").alias("pos"), "n", value)


HASH_BITS = 60


def order_hash(*parts: Column) -> Column:
    """A whole number below 2**60 from the md5 of the parts joined by ":" (an order
    that other engines share)."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_bucket(h: str, buckets: int) -> Column:
    """Bucket of an ``order_hash`` by its top bits, at least ``buckets`` of them (a power of two)."""
    bits = max(0, (buckets - 1).bit_length())
    return (F.shiftright(F.col(h), HASH_BITS - bits) if bits else F.lit(0)).cast("bigint")


def positions(df: DataFrame, keys: Sequence[str], seed: int, id_col: str, out: str = "pos",
              per_bucket: int | None = None) -> DataFrame:
    """0-based position of each row within its key in the seeded hash order
    ``(order_hash(id, seed), id)``."""
    h = df.withColumn("_h", order_hash(F.col(id_col), F.lit(seed))).withColumn("_one", F.lit(1))
    bucket = hash_bucket("_h", math.ceil(df.count() / rows_per_bucket(df, per_bucket)))
    rt = running_totals(h, keys, ["_h", id_col], ["_one"], bucket=bucket)
    return rt.withColumn(out, F.col("cum__one") - 1).drop("_h", "_one", "cum__one")
