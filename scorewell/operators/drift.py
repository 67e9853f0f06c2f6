"""Two-tier drift checks (A9-A13, G6-G8, S10, S13) in long form.

All features are handled in one job per statistic: values are unpivoted to
``(feature, side, num, cat)`` and grouped by feature, never looped per feature.

* PSI: numeric bins are the baseline deciles (exact, linear interpolation,
  de-duplicated, outer edges +-inf, a value equal to an inner edge goes right);
  categorical bins are the union of categories.  Proportions are clipped at
  1e-4 on both sides and not renormalised.  A constant baseline gives 0.
* KS: exact two-sample statistic from distributed running counts; asymptotic
  Kolmogorov p-value (the reference library switches to an exact p-value for
  small samples, so verdicts can differ right at .05 / .01).
* Chi-square on the 2 x k table of counts, Yates-corrected when k = 2;
  fewer than two categories -> p = 1.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewell.operators.ordered import running_totals, with_totals
from scorewell.operators.sampling import hash_sample
from scorewell.operators.validate import drift_result_constraints, enforce_constraints
from scorewell.session import staged

# PSI bins, clipping, verdict thresholds, baseline sample size.
PSI_BINS = 10
PSI_EPSILON = 1e-4
PSI_FLAG, PSI_STOP = 0.1, 0.25
P_FLAG, P_STOP = 0.05, 0.01
KS_EXACT_ROWS = 10_000  # the reference library computes exact p-values up to so many rows a side
BASELINE_SAMPLE_SIZE = 10_000

BASE, CUR = "baseline", "current"


def to_long(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
            side: str | Column | None = None) -> DataFrame:
    """Wide -> ``(feature, [side,] num, cat)``; one row per (row, feature)."""
    structs = ([F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("num"),
                         F.lit(None).cast("string").alias("cat")) for c in numeric]
               + [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("num"),
                           F.col(f"`{c}`").cast("string").alias("cat")) for c in categorical])
    has_side = side is not None
    extra = [(side if isinstance(side, Column) else F.lit(side)).alias("side")] if has_side else []
    return df.select(*extra, F.explode(F.array(*structs)).alias("_f")).select(
        F.col("_f.feature").alias("feature"), *(["side"] if has_side else []),
        F.col("_f.num").alias("num"), F.col("_f.cat").alias("cat"))


def _valid_num():
    return F.col("num").isNotNull() & ~F.isnan("num")


def value_counts(long: DataFrame) -> DataFrame:
    """``(feature, side, num, cat, n)``: the long form reduced once (partial aggregation).

    Every statistic below reads this table, so the wide input is scanned once
    per drift check however many statistics are computed."""
    if "n" in long.columns:
        return long
    return long.groupBy("feature", "side", "num", "cat").agg(F.count(F.lit(1)).alias("n"))


def _lerp(a: float, b: float, t: float) -> float:
    # numpy's linear interpolation (rounds from the nearer end)
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def ranked_values(long: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Distinct values per feature with both sides' counts, running counts and totals
    (feature, num, b, c, cum_b, cum_c, nb, nc), put in order once and staged: quantile
    edges and KS both read it."""
    vc = (value_counts(long).where(F.col("feature").isin(list(numeric)) & _valid_num())
          .groupBy("feature", "num")
          .agg(F.sum(F.when(F.col("side") == BASE, F.col("n")).otherwise(0)).alias("b"),
               F.sum(F.when(F.col("side") == CUR, F.col("n")).otherwise(0)).alias("c")))
    vc = staged(vc, "drift-values")
    rt = with_totals(running_totals(vc, ["feature"], ["num"], ["b", "c"]), ["feature"], {"nb": F.col("b"), "nc": F.col("c")})
    return staged(rt, "drift-ranks")


def quantile_edges(long: DataFrame, n_bins: int = PSI_BINS, ranked: DataFrame | None = None) -> dict:
    """Exact quantiles 0, 1/n, ..., 1 of the baseline's ``num`` per feature (linear interpolation).

    Positions come from distributed running counts; only ``2 (n_bins + 1)``
    values per feature reach the driver.
    """
    if ranked is None:
        base = value_counts(long).where(F.col("num").isNotNull()).withColumn("side", F.lit(BASE))
        ranked = ranked_values(base, [r["feature"] for r in base.select("feature").distinct().collect()])  # feature names
    n = F.col("nb")
    named = []
    for i in range(n_bins + 1):
        lo = F.floor(F.lit(i / n_bins) * (n - 1)).cast("bigint")
        named += [F.struct(F.lit(f"{i}:lo").alias("name"), lo.alias("pos")), F.struct(F.lit(f"{i}:hi").alias("name"), F.least(lo + 1, n - 1).alias("pos"))]
    here = F.filter(F.array(*named), lambda t: (t["pos"] >= F.col("cum_b") - F.col("b")) & (t["pos"] < F.col("cum_b")))
    picks = ranked.where("b > 0").select("feature", "num", "nb", F.explode(here.getField("name")).alias("name")).collect()
    got = {(r["feature"], r["name"]): r["num"] for r in picks}
    edges = {}
    for f, n in {r["feature"]: r["nb"] for r in picks}.items():
        e = []
        for i in range(n_bins + 1):
            h = (i / n_bins) * (n - 1)
            e.append(_lerp(got[(f, f"{i}:lo")], got[(f, f"{i}:hi")], h - math.floor(h)))
        edges[f] = sorted(set(e))
    return edges


def _edges_lookup(edges: Mapping[str, Sequence[float]]) -> Column:
    """Inner edges per feature as a literal map (a handful of numbers per feature)."""
    inner = {f: list(e[1:-1]) for f, e in edges.items()}
    if not inner:
        return F.lit(None).cast("array<double>")
    m = F.create_map(*[x for f, e in inner.items()
                       for x in (F.lit(f), F.array(*[F.lit(float(v)) for v in e]) if e
                                 else F.array().cast("array<double>"))])
    return F.try_element_at(m, F.col("feature"))


def histogram(long: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """A10: ``(feature, side, bin, n)``; bin = number of inner edges <= value."""
    inner = _edges_lookup(edges)
    return (value_counts(long).where(_valid_num() & F.col("feature").isin(list(edges)))
            .withColumn("bin", F.size(F.filter(inner, lambda e: e <= F.col("num"))))
            .groupBy("feature", "side", "bin").agg(F.sum("n").alias("n")))


def _psi_terms(counts: DataFrame, cell: str) -> DataFrame:
    """Sum of clipped PSI terms per feature from ``(feature, side, cell, n)`` counts."""
    p = counts.groupBy("feature", cell).agg(
        F.sum(F.when(F.col("side") == BASE, F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("side") == CUR, F.col("n")).otherwise(0)).alias("c"))
    t = with_totals(p, ["feature"], {"nb": F.col("b"), "nc": F.col("c")})
    bp = F.greatest(F.try_divide(F.col("b"), F.col("nb")), F.lit(PSI_EPSILON))
    cp = F.greatest(F.try_divide(F.col("c"), F.col("nc")), F.lit(PSI_EPSILON))
    both = (F.first("nb") > 0) & (F.first("nc") > 0)  # an empty side has no distribution to compare
    return (t.groupBy("feature")
            .agg(F.when(both, F.sum((cp - bp) * F.log(cp / bp))).alias("psi"),
                 F.first("nb").alias("n_baseline"), F.first("nc").alias("n_current")))


def psi(long: DataFrame, feature_types: Mapping[str, str], n_bins: int = PSI_BINS,
        edges: Mapping | None = None) -> DataFrame:
    """``(feature, feature_type, psi)`` for every feature in one pass per type."""
    bad = {f: t for f, t in feature_types.items() if t not in ("numeric", "categorical")}
    if bad:
        raise ValueError(f"unknown feature type: {bad}")
    num = [f for f, t in feature_types.items() if t == "numeric"]
    cat = [f for f, t in feature_types.items() if t == "categorical"]
    parts = []
    long = value_counts(long)
    if num:
        if edges is None:
            edges = quantile_edges(long.where((F.col("side") == BASE) & F.col("feature").isin(num)), n_bins)
        ok = {f: e for f, e in edges.items() if len(e) >= 2}
        const = [f for f in num if f not in ok]
        if ok:
            parts.append(_psi_terms(histogram(long.where(F.col("feature").isin(list(ok))), ok), "bin")
                         .select("feature", F.lit("numeric").alias("feature_type"), "psi"))
        if const:
            spark = long.sparkSession
            parts.append(spark.createDataFrame([(f, "numeric", 0.0) for f in const],
                                               "feature string, feature_type string, psi double"))
    if cat:
        c = (value_counts(long).where(F.col("feature").isin(cat) & F.col("cat").isNotNull())
             .groupBy("feature", "side", "cat").agg(F.sum("n").alias("n")))
        parts.append(_psi_terms(c, "cat").select("feature", F.lit("categorical").alias("feature_type"), "psi"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided Kolmogorov p-value ``Q(D sqrt(nm/(n+m)))``; 1.0 below lambda 0.2."""
    lam = d * F.sqrt(n * m / (n + m))
    s = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                    lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam))
    return F.when(lam.isNull(), F.lit(None)).when(lam < 0.2, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * s)))


def ks_exact_pvalue(d: Column, n: Column, m: Column) -> Column:
    """Exact two-sided p-value: the share of lattice paths from (0, 0) to (n, m) on which
    the two empirical distributions ever differ by ``d`` or more.

    ``d`` is rounded to the nearest multiple of 1 / lcm(n, m), which it is one of.  The
    paths are followed diagonal by diagonal; of each only the stretch within ``d`` is
    kept, and what left it counts as 1.  All terms are positive, so small p-values
    keep their digits.
    """
    n, m = n.cast("bigint"), m.cast("bigint")
    # |i m - j n| >= reach leaves; d n m is a whole number up to rounding
    reach = F.round(d * n * m).cast("bigint")
    state = F.struct(F.lit(0).cast("bigint").alias("low"), F.array(F.lit(0.0)).alias("g"))

    def step(before: Column, s: Column) -> Column:
        low = F.greatest(F.floor((s * n - reach) / (n + m)) + 1, s - m, F.lit(0)).cast("bigint")
        high = F.least(F.ceil((s * n + reach) / (n + m)) - 1, n, s).cast("bigint")
        seen = lambda i: F.coalesce(F.get(before["g"], (i - before["low"]).cast("int")), F.lit(1.0))
        cells = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
        g = F.transform(cells, lambda i: (seen(i - 1) * i + seen(i) * (s - i)) / s)
        return F.struct(low.alias("low"), g.alias("g"))

    end = F.aggregate(F.sequence(F.lit(1).cast("bigint"), n + m), state, step, lambda x: F.coalesce(F.get(x["g"], F.lit(0)), F.lit(1.0)))
    return F.when(reach <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), end))


def ks_pvalue_auto(d: Column, n: Column, m: Column) -> Column:
    """The rule of the reference's library: exact up to ``KS_EXACT_ROWS`` rows a side, else
    asymptotic."""
    small = (F.greatest(n, m) <= KS_EXACT_ROWS) & (F.least(n, m) > 0)
    return F.when(d.isNull(), F.lit(None).cast("double")).when(small, ks_exact_pvalue(d, n, m)) \
        .otherwise(ks_pvalue(d, n.cast("double"), m.cast("double")))


def ks(long: DataFrame, numeric: Sequence[str], ranked: DataFrame | None = None) -> DataFrame:
    """``(feature, ks_statistic, p_value, n_baseline, n_current)`` from running counts."""
    rt = ranked if ranked is not None else ranked_values(long, numeric)
    diff = F.abs(F.try_divide(F.col("cum_b").cast("double"), F.col("nb")) - F.try_divide(F.col("cum_c").cast("double"), F.col("nc")))
    g = rt.groupBy("feature").agg(F.max(diff).alias("ks_statistic"), F.first("nb").alias("n_baseline"), F.first("nc").alias("n_current"))
    rows = long.sparkSession.createDataFrame(g.collect(), g.schema)  # one row per feature
    return rows.select("feature", "ks_statistic", ks_pvalue_auto(F.col("ks_statistic"), F.col("n_baseline"), F.col("n_current")).alias("p_value"),
                       "n_baseline", "n_current")


def chi2_statistic(long: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """A13 statistic: ``(feature, chi2_statistic, dof, n_categories)``; Yates when k = 2."""
    c = (value_counts(long).where(F.col("feature").isin(list(categorical)) & F.col("cat").isNotNull())
         .groupBy("feature", "cat")
         .agg(F.sum(F.when(F.col("side") == BASE, F.col("n")).otherwise(0)).alias("b"),
              F.sum(F.when(F.col("side") == CUR, F.col("n")).otherwise(0)).alias("c")))
    c = with_totals(c, ["feature"], {"nb": F.col("b"), "nc": F.col("c"), "kk": F.lit(1)})
    nb, nc, kk = F.col("nb").cast("double"), F.col("nc").cast("double"), F.col("kk")
    n = nb + nc
    col_tot = F.col("b") + F.col("c")

    def term(obs, row_tot):
        e = row_tot * col_tot / n
        d = e - obs
        adj = F.when(kk == 2, F.signum(d) * F.least(F.lit(0.5), F.abs(d))).otherwise(F.lit(0.0))
        return F.try_divide(F.pow(obs + adj - e, 2), e)

    return (c.groupBy("feature")
            .agg(F.sum(term(F.col("b"), nb) + term(F.col("c"), nc)).alias("chi2_statistic"),
                 F.first(kk).alias("n_categories"))
            .select("feature", "chi2_statistic", (F.col("n_categories") - 1).cast("int").alias("dof"),
                    F.col("n_categories").cast("int").alias("n_categories")))


def erfc(z: Column, terms: int = 80) -> Column:
    """Complementary error function of z >= 0: the power series up to 2.5, the
    continued fraction (evaluated from its end) above."""
    k = F.sequence(F.lit(1), F.lit(terms))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def add(acc: Column, n: Column) -> Column:
        t = acc["t"] * 2.0 * z * z / (2 * n + 1)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    series = 1.0 - 2.0 / math.sqrt(math.pi) * z * F.exp(-z * z) * F.aggregate(k, start, add, lambda acc: acc["s"])
    far = F.aggregate(F.reverse(k), F.lit(1.0), lambda f, n: 1.0 + n / (2.0 * z * z) / f)
    return F.when(z <= 2.5, series).otherwise(F.exp(-z * z) / (z * math.sqrt(math.pi) * far))


def chi2_sf(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution for whole degrees of freedom, as a
    finite sum of Poisson-like terms (plus erfc when dof is odd); 1 where dof < 1 or x <= 0."""
    z = x.cast("double") / 2.0
    odd = dof % 2 == 1
    first = F.when(odd, 2.0 * F.sqrt(z / math.pi) * F.exp(-z)).otherwise(F.exp(-z))
    half = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    n_terms = F.floor(dof / 2).cast("int")
    start = F.struct(first.alias("t"), F.lit(0.0).alias("s"))

    def add(acc: Column, k: Column) -> Column:
        return F.struct((acc["t"] * z / (k + half)).alias("t"), (acc["s"] + acc["t"]).alias("s"))

    total = F.aggregate(F.when(n_terms > 0, F.sequence(F.lit(1), n_terms)).otherwise(F.array().cast("array<int>")),
                        start, add, lambda acc: acc["s"])
    tail = total + F.when(odd, erfc(F.sqrt(z))).otherwise(F.lit(0.0))
    return F.when(x.isNull() | dof.isNull() | (dof < 1) | (x <= 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), tail))


def chi2(long: DataFrame, categorical: Sequence[str]) -> DataFrame:
    s = chi2_statistic(long, categorical)
    return s.withColumn("p_value", F.when(F.col("n_categories") < 2, F.lit(1.0))
                        .otherwise(chi2_sf(F.col("chi2_statistic"), F.col("dof"))))


def verdict(psi_col: Column, p_col: Column) -> Column:
    """PSI >= .25 or p < .01 stop; PSI >= .1 or p < .05 flag; otherwise pass."""
    return (F.when(psi_col.isNull() | p_col.isNull(), F.lit("flag"))
            .when((psi_col >= PSI_STOP) | (p_col < P_STOP), "stop")
            .when((psi_col >= PSI_FLAG) | (p_col < P_FLAG), "flag").otherwise("pass"))


def drift_check(baseline: DataFrame, current: DataFrame, feature_types: Mapping[str, str],
                n_bins: int = PSI_BINS) -> DataFrame:
    """Every feature in one long-form job: PSI plus KS (numeric) or chi-square (categorical).

    ``baseline`` / ``current`` are wide frames holding the feature columns.
    """
    num = [f for f, t in feature_types.items() if t == "numeric"]
    cat = [f for f, t in feature_types.items() if t == "categorical"]
    long = value_counts(to_long(baseline, num, cat, BASE).unionByName(to_long(current, num, cat, CUR))).persist()
    ranked = ranked_values(long, num) if num else None
    p = psi(long, feature_types, n_bins, quantile_edges(long, n_bins, ranked) if num else None)
    tests = []
    if num:
        tests.append(ks(long, num, ranked).select("feature", F.lit("ks").alias("statistical_test"),
                                          F.col("ks_statistic").alias("statistic"), "p_value",
                                          "n_baseline", "n_current"))
    if cat:
        c = chi2(long, cat)
        sizes = (long.where(F.col("feature").isin(cat) & F.col("cat").isNotNull())
                 .groupBy("feature").agg(F.sum(F.when(F.col("side") == BASE, F.col("n")).otherwise(0)).alias("n_baseline"),
                                         F.sum(F.when(F.col("side") == CUR, F.col("n")).otherwise(0)).alias("n_current")))
        tests.append(c.join(sizes, "feature").select(
            "feature", F.lit("chi2").alias("statistical_test"), F.col("chi2_statistic").alias("statistic"),
            "p_value", "n_baseline", "n_current"))
    t = tests[0]
    for x in tests[1:]:
        t = t.unionByName(x)
    counted = F.when(F.col("feature").isin(num), _valid_num()).otherwise(F.col("cat").isNotNull()) if num else F.col("cat").isNotNull()
    gone = lambda side: F.coalesce(F.sum(F.when((F.col("side") == side) & ~counted, F.col("n"))), F.lit(0)).cast("bigint")
    left_out = long.groupBy("feature").agg(gone(BASE).alias("n_excluded_baseline"), gone(CUR).alias("n_excluded_current"))
    out = p.join(t, "feature", "left").join(left_out, "feature", "left").select(
        "feature", "feature_type", "psi", "statistical_test", "statistic", "p_value",
        verdict(F.col("psi"), F.col("p_value")).alias("verdict"),
        F.when(F.coalesce("n_baseline", F.lit(0)) == 0, "empty baseline").when(F.coalesce("n_current", F.lit(0)) == 0, "empty current")
        .alias("reason"),
        F.col("n_baseline").cast("bigint").alias("sample_size_baseline"),
        F.col("n_current").cast("bigint").alias("sample_size_current"),
        "n_excluded_baseline", "n_excluded_current")
    rows = out.collect()  # one row per feature
    long.unpersist()
    return long.sparkSession.createDataFrame(rows, out.schema)


def override_values(current_long: DataFrame, overrides: DataFrame) -> DataFrame:
    """``overrides`` (feature, num) replace that feature's current values; others keep theirs."""
    keep = current_long.join(overrides.select("feature").distinct(), "feature", "left_anti")
    add = overrides.select("feature", F.lit(CUR).alias("side"), F.col("num").cast("double").alias("num"),
                           F.lit(None).cast("string").alias("cat"))
    return keep.unionByName(add.select(*keep.columns))


def read_override_json(spark, path: str) -> DataFrame:
    """S10 source: a JSON object ``{feature: [numbers]}`` -> (feature, num)."""
    raw = spark.read.option("multiLine", True).json(path)
    cols = raw.columns
    return raw.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("v"))
                                          for c in cols])).alias("x")) \
        .select("x.feature", F.explode("x.v").alias("num"))


def baseline_long(df: DataFrame, columns: Sequence[str], computed_at: Column | None = None) -> DataFrame:
    """Wide -> long ``(feature_name, value, computed_at)`` with ``unpivot``."""
    at = computed_at if computed_at is not None else F.current_timestamp()
    return (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
            .unpivot([], [F.col(f"`{c}`") for c in columns], "feature_name", "value")
            .withColumn("computed_at", at))


def build_baseline(df: DataFrame, key: str, prepare: Callable[[DataFrame], DataFrame], features: Sequence[str],
                   output: str, n: int = BASELINE_SAMPLE_SIZE, seed: int = 42, computed_at: Column | None = None) -> DataFrame:
    """The long baseline of a fixed seeded sample.

    S4 sample of ``n`` rows -> ``prepare`` (preparation and scoring of the sample
    only) -> S13 long form of the features and the model output.
    """
    return baseline_long(prepare(hash_sample(df, n, key, seed)), [*features, output], computed_at)


def read_baseline(spark, path: str) -> DataFrame:
    """The stored long baseline ``(feature_name, value, computed_at)``; error if empty.

    Stays a long DataFrame (``feature``, ``side``, ``num``, ``cat``); never collected.
    """
    b = spark.read.parquet(path)
    if b.limit(1).count() == 0:
        raise ValueError(f"drift baseline is empty: {path}")
    return b.select(F.col("feature_name").alias("feature"), F.lit(BASE).alias("side"),
                    F.col("value").cast("double").alias("num"), F.lit(None).cast("string").alias("cat"))


def append_results(results: DataFrame, path: str, computed_at: Column | None = None) -> None:
    """One row per feature per run, appended; a row that breaks the table's rules
    (V6) fails the write."""
    at = computed_at if computed_at is not None else F.current_timestamp()
    enforce_constraints(results, drift_result_constraints()).withColumn("computed_at", at).write.mode("append").parquet(path)
