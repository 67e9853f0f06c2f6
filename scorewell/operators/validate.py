"""Row validation (V1-V7): one projection builds the list of violations per row.

A ``Contract`` names required columns, numeric ranges, category domains and
not-null columns.  ``violations`` adds ``array<struct<column, rule>>``; the
whole batch can then be rejected (``assert_valid``) or split into good / bad.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATIONS = "_violations"


@dataclass(frozen=True)
class Range:
    lo: float | None = None
    hi: float | None = None
    lo_inclusive: bool = True
    hi_inclusive: bool = True
    integer: bool = False


@dataclass
class Contract:
    """Column rules.  Extra columns are allowed; listed ones are required."""

    numeric: Mapping[str, Range] = field(default_factory=dict)
    categories: Mapping[str, Sequence] = field(default_factory=dict)
    not_null: Sequence[str] = ()
    required: Sequence[str] = ()

    def columns(self) -> list[str]:
        seen: list[str] = []
        for c in [*self.required, *self.numeric, *self.categories, *self.not_null]:
            if c not in seen:
                seen.append(c)
        return seen


class ContractError(ValueError):
    pass


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """V3: a missing column is an error (checked on the schema, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {missing}")


def _v(column: str, rule: str, bad: Column) -> Column:
    return F.when(bad, F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule")))


def violation_terms(contract: Contract) -> list[Column]:
    terms: list[Column] = []
    nn = set(contract.not_null) | set(contract.numeric) | set(contract.categories)
    for c in contract.columns():
        if c in nn:
            terms.append(_v(c, "not_null", F.col(c).isNull()))
    for c, r in contract.numeric.items():
        raw = F.col(c)
        num = raw.try_cast("double")
        bad_type = raw.isNotNull() & (num.isNull() | F.isnan(num))
        terms.append(_v(c, "type", bad_type))
        if r.integer:
            terms.append(_v(c, "type", num.isNotNull() & ~F.isnan(num) & (num != F.floor(num))))
        out = F.lit(False)
        if r.lo is not None:
            out = out | ((num < r.lo) if r.lo_inclusive else (num <= r.lo))
        if r.hi is not None:
            out = out | ((num > r.hi) if r.hi_inclusive else (num >= r.hi))
        terms.append(_v(c, "range", num.isNotNull() & ~F.isnan(num) & out))
    for c, dom in contract.categories.items():
        terms.append(_v(c, "domain", F.col(c).isNotNull() & ~F.col(c).cast("string").isin([str(x) for x in dom])))
    return terms


def violations(df: DataFrame, contract: Contract, out: str = VIOLATIONS) -> DataFrame:
    """Add ``out: array<struct<column,rule>>`` (empty when the row is valid)."""
    require_columns(df, contract.columns())
    terms = violation_terms(contract)
    arr = F.array(*terms) if terms else F.array()
    return df.withColumn(out, F.filter(arr, lambda x: x.isNotNull()))


def split_valid(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(good rows without the violation column, bad rows with it)."""
    v = violations(df, contract)
    good = v.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
    bad = v.where(F.size(VIOLATIONS) > 0)
    return good, bad


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """(column, rule, n_bad) for every rule that any row breaks."""
    v = violations(df, contract).select(F.explode(VIOLATIONS).alias("v"))
    return (v.groupBy(F.col("v.column").alias("column"), F.col("v.rule").alias("rule"))
            .agg(F.count(F.lit(1)).alias("n_bad")))


def assert_valid(df: DataFrame, contract: Contract) -> None:
    """Whole-batch rejection: one aggregate; raises listing the broken rules."""
    counts = violation_counts(df, contract).collect()  # at most (#columns x #rules) rows
    if counts:
        detail = ", ".join(f"{r['column']}:{r['rule']}={r['n_bad']}" for r in counts)
        raise ContractError(f"batch rejected: {detail}")


def constraint_counts(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """V6: named boolean constraints -> one row of violation counts (``count_if(NOT ok)``)."""
    aggs = [F.sum(F.when(F.coalesce(expr, F.lit(False)), 0).otherwise(1)).cast("bigint").alias(name)
            for name, expr in constraints.items()]
    return df.agg(*aggs)


def enforce_constraints(df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Lazily fail the job on the first row that breaks a constraint (``assert_true``)."""
    cond = F.lit(True)
    for expr in constraints.values():
        cond = cond & F.coalesce(expr, F.lit(False))
    return df.where(F.assert_true(cond, "constraint violated").isNull())


def drift_result_constraints() -> dict[str, Column]:
    """V6 rules of the drift results: kinds, tests and verdicts are of fixed lists."""
    one = lambda c, *v: F.col(c).isin(*v)
    return {"feature_type": one("feature_type", "numeric", "categorical"), "statistical_test": one("statistical_test", "ks", "chi2"),
            "verdict": one("verdict", "pass", "flag", "stop"),
            "p_value": F.col("p_value").isNull() | F.col("p_value").between(0, 1)}


def gate_run_constraints() -> dict[str, Column]:
    """V6 rules of the gate's history."""
    return {"verdict": F.col("verdict").isin("pass", "flag", "stop"), "row_count": F.col("row_count") >= 0,
            "source_table": F.col("source_table").isNotNull()}


def generation_run_constraints(most: int = 100_000) -> dict[str, Column]:
    """V6 rules of the generation runs: requested rows in 1..most, a known status, no more inserted than asked for."""
    return {"requested_count": F.col("requested_count").between(1, most), "status": F.col("status").isin("completed", "failed"),
            "inserted_count": F.col("inserted_count").between(0, F.col("requested_count"))}


def missing_report(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """V7: number of null (or NaN) values per column, optionally per group; long form."""
    aggs = []
    for c in cols:
        dt = dict(df.dtypes)[c]
        isn = F.col(c).isNull()
        if dt in ("double", "float"):
            isn = isn | F.isnan(c)
        aggs.append(F.sum(isn.cast("bigint")).alias(c))
    wide = df.groupBy(*by).agg(*aggs)
    return wide.unpivot(list(by), list(cols), "column", "n_missing")


def one_of_filled(a: str, b: str) -> Column:
    """XOR identity rule: exactly one of two id columns is filled."""
    return F.col(a).isNotNull() != F.col(b).isNotNull()


def preparation_checks(before: DataFrame, after: DataFrame, dropped: Sequence[str], added: Sequence[str],
                       tenure_dummies: Sequence[str], contract_dummies: Sequence[str], kept: str,
                       scaled: str, residual: str) -> dict:
    """V5: the seven checks on a prepared frame (schema checks + one aggregate).

    Dropped columns gone, new columns present, the tenure and contract dummies
    present, ``kept`` still there, |mean of the scaled column| < 0.01 and fewer
    than 50 % zero residuals.
    """
    cols = set(after.columns)
    out = {"dropped_gone": all(c not in cols for c in dropped),
           "added_present": all(c in cols for c in added),
           "tenure_dummies": all(c in cols for c in tenure_dummies),
           "contract_dummies": all(c in cols for c in contract_dummies),
           "kept_present": kept in cols}
    r = after.agg(F.avg(F.col(f"`{scaled}`")).alias("m"),
                  F.avg((F.col(f"`{residual}`") == 0).cast("double")).alias("z")).first()
    out["scaled_mean_near_zero"] = r["m"] is not None and abs(r["m"]) < 0.01
    out["residual_mostly_nonzero"] = r["z"] is not None and r["z"] < 0.5
    return out
