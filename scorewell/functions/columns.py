"""Column expressions (JVM-side, codegen friendly) used by the operators.

Every function returns a ``Column``; nothing here triggers a job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def residual(total, tenure, monthly) -> Column:
    """``total - tenure * monthly``; null inputs stay null."""
    return _c(total) - _c(tenure) * _c(monthly)


def safe_ratio(num, den, default: float = 1.0) -> Column:
    """``num / den``; a zero or missing denominator, or a null or NaN result -> ``default``."""
    r = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.when(r.isNull() | F.isnan(r), F.lit(float(default))).otherwise(r)


def interval_bin(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins with the lowest edge included.

    ``edges=[0, 2, 18, 44, 72]``: 0..2 -> labels[0], (2, 18] -> labels[1], ...
    Values outside ``[edges[0], edges[-1]]``, null and NaN give null.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    x = _c(c)
    expr = F.when(x.isNull() | F.isnan(x.cast("double")) | (x < edges[0]), F.lit(None))
    for hi, lab in zip(edges[1:], labels):
        expr = expr.when(x <= hi, F.lit(lab))
    return expr.otherwise(F.lit(None).cast("string"))


def membership_flag(c, values: Sequence) -> Column:
    """1 when the value is one of ``values``; null and anything else -> 0."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False)).cast("int")


def count_equal(cols: Sequence, value="Yes") -> Column:
    """Number of the given columns whose value equals ``value`` exactly; null counts 0."""
    terms = [F.when(_c(c) == F.lit(value), 1).otherwise(0) for c in cols]
    if not terms:
        return F.lit(0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def any_flag(count) -> Column:
    return (_c(count) > 0).cast("int")


def map_values(c, mapping: Mapping, otherwise=None) -> Column:
    """Literal lookup ``mapping[c]``; an unmapped value gives ``otherwise`` (default null)."""
    x = _c(c)
    items = list(mapping.items())
    if not items:
        return F.lit(otherwise)
    expr = F.when(x == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(x == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(otherwise))


def label_from_threshold(prob, threshold: float) -> Column:
    """1 when ``prob >= threshold`` else 0 (null stays null)."""
    p = _c(prob)
    return F.when(p.isNull(), F.lit(None)).when(p >= F.lit(float(threshold)), 1).otherwise(0)


def parent_feature(c, parents: Sequence[str]) -> Column:
    """Parent of a one-hot name: the first ``parent`` whose ``parent_`` prefixes it, else itself."""
    x = _c(c)
    if not parents:
        return x
    expr = F.when(x.startswith(parents[0] + "_"), F.lit(parents[0]))
    for p in parents[1:]:
        expr = expr.when(x.startswith(p + "_"), F.lit(p))
    return expr.otherwise(x)


# Verdict codes used by the drift gauges and the run-status gauge.
DRIFT_VERDICT_CODE = {"pass": 2, "flag": 1, "stop": 0}
RUN_STATUS_CODE = {"completed": 1, "failed": 0}
VERDICT_ORDER = {"pass": 0, "flag": 1, "stop": 2}


def verdict_code(c) -> Column:
    """Drift verdict -> 2 (pass) / 1 (flag) / 0 (stop); unknown -> -1."""
    return map_values(c, DRIFT_VERDICT_CODE, -1)


def run_status_code(c) -> Column:
    """Run status -> 1 completed / 0 failed; anything else (never ran) -> -1."""
    return map_values(c, RUN_STATUS_CODE, -1)


def verdict_rank(c) -> Column:
    """pass 0 < flag 1 < stop 2, for ``max`` = worst verdict."""
    return map_values(c, VERDICT_ORDER, None)


def verdict_from_rank(c) -> Column:
    inv = {v: k for k, v in VERDICT_ORDER.items()}
    return map_values(c, inv, None)


def project_labels(c, keys: Sequence[str]) -> Column:
    """Keep only the given keys of a ``map<string,string>``; absent keys are omitted."""
    arr = F.array(*[F.lit(k) for k in keys]) if keys else F.array().cast("array<string>")
    return F.map_filter(_c(c), lambda k, v: F.array_contains(arr, k))


def ts_micros(c) -> Column:
    """Epoch microseconds of a timestamp / timestamp_ntz column (UTC session)."""
    return F.unix_micros(_c(c).cast("timestamp"))


def r6(c) -> Column:
    """Round a double to 6 digits (used where results are compared across engines)."""
    return F.round(_c(c).cast("double"), 6)
