"""Fixture queries: drift of lineitem shipped from 1998 on against the lines before."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.columns import r6
from scorewell.operators import drift as D
from scorewell.plans.tables import table
from scorewell.session import shared_path

# Fixed values of the fixture.
CUTOFF = "1998-01-01"
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
TYPES = {**{c: "numeric" for c in NUMERIC}, **{c: "categorical" for c in CATEGORICAL}}


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    side = F.when(F.col("l_shipdate") < F.lit(CUTOFF).cast("timestamp_ntz"), D.BASE).otherwise(D.CUR)
    return D.to_long(li, NUMERIC, CATEGORICAL, side)


def drift_psi(spark, sf_dir):
    return D.psi(_long(spark, sf_dir), TYPES).select("feature", "feature_type", r6("psi").alias("psi"))


def drift_ks(spark, sf_dir):
    k = D.ks(_long(spark, sf_dir), NUMERIC)
    return k.select("feature", r6("ks_statistic").alias("ks_statistic"), r6("p_value").alias("p_value"),
                    "n_baseline", "n_current")


def drift_chi2(spark, sf_dir):
    c = D.chi2_statistic(_long(spark, sf_dir), CATEGORICAL)
    return c.select("feature", r6("chi2_statistic").alias("chi2_statistic"), "dof", "n_categories")


def drift_check(spark, sf_dir):
    """PSI + KS / chi-square p-values + verdict for every feature in one job."""
    li = table(spark, sf_dir, "lineitem")
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    out = D.drift_check(li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut), TYPES)
    return out.select("feature", "feature_type", r6("psi").alias("psi"), "statistical_test",
                      r6("statistic").alias("statistic"), r6("p_value").alias("p_value"), "verdict",
                      "sample_size_baseline", "sample_size_current")


def drift_baseline(spark, sf_dir):
    """G6 + S13 + S8: 10,000 sampled lines, scored, stored long and read back."""
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    long = D.build_baseline(li, "row_id", lambda d: d.withColumn("score", 0.02 * F.col("l_quantity") - F.col("l_discount")),
                            ["l_quantity", "l_discount"], "score")
    path = shared_path(spark, "scorewell-baseline", os.urandom(8).hex())
    long.write.parquet(path)
    b = D.read_baseline(spark, path)
    return b.groupBy("feature").agg(F.count("num").alias("n"), r6(F.avg("num")).alias("mean"), r6(F.max("num")).alias("largest"))


def drift_override(spark, sf_dir):
    """S10 + A11: values from elsewhere (events) in place of one feature's current ones."""
    over = table(spark, sf_dir, "events").where("value is not null").select(F.lit("l_tax").alias("feature"), (F.col("value") / 1000).alias("num"))
    long = _long(spark, sf_dir).select("feature", "side", "num", "cat")
    long = long.where(F.col("side") == D.BASE).unionByName(D.override_values(long.where(F.col("side") == D.CUR), over))
    return D.psi(long, TYPES).select("feature", "feature_type", r6("psi").alias("psi"))


QUERIES = {"drift_baseline": drift_baseline, "drift_override": drift_override, "drift_psi": drift_psi, "drift_ks": drift_ks, "drift_chi2": drift_chi2, "drift_check": drift_check}

_LONG = """li AS (
  SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'baseline' ELSE 'current' END AS side, * FROM lineitem
), long AS (
  SELECT side, 'l_quantity' AS feature, CAST(l_quantity AS DOUBLE) AS num FROM li
  UNION ALL SELECT side, 'l_extendedprice', l_extendedprice FROM li
  UNION ALL SELECT side, 'l_discount', l_discount FROM li
  UNION ALL SELECT side, 'l_tax', l_tax FROM li
), valid AS (SELECT * FROM long WHERE num IS NOT NULL AND NOT isnan(num)),
cats AS (
  SELECT side, 'l_returnflag' AS feature, l_returnflag AS cat FROM li WHERE l_returnflag IS NOT NULL
  UNION ALL SELECT side, 'l_linestatus', l_linestatus FROM li WHERE l_linestatus IS NOT NULL
)"""

ORACLE = {
    "drift_psi": f"""WITH {_LONG},
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(num, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
  FROM valid WHERE side = 'baseline' GROUP BY feature
), binned AS (
  SELECT v.feature, v.side, len(list_filter(e[2:len(e) - 1], lambda x: x <= v.num)) AS bin, count(*) AS n
  FROM valid v JOIN edges USING (feature) WHERE len(e) >= 2 GROUP BY ALL
), cc AS (SELECT feature, side, cat AS bin, count(*) AS n FROM cats GROUP BY ALL),
p AS (
  SELECT feature, bin::VARCHAR AS bin, sum(CASE WHEN side = 'baseline' THEN n ELSE 0 END) AS b,
         sum(CASE WHEN side = 'current' THEN n ELSE 0 END) AS c, 'numeric' AS feature_type FROM binned GROUP BY ALL
  UNION ALL
  SELECT feature, bin, sum(CASE WHEN side = 'baseline' THEN n ELSE 0 END), sum(CASE WHEN side = 'current' THEN n ELSE 0 END),
         'categorical' FROM cc GROUP BY ALL
), t AS (SELECT feature, sum(b) AS nb, sum(c) AS nc FROM p GROUP BY feature),
q AS (SELECT p.*, greatest(b / nb, 1e-4) AS bp, greatest(c / nc, 1e-4) AS cp FROM p JOIN t USING (feature))
SELECT feature, feature_type, round(sum((cp - bp) * ln(cp / bp)), 6) AS psi FROM q GROUP BY feature, feature_type
UNION ALL
SELECT feature, 'numeric', 0.0 FROM edges WHERE len(e) < 2""",
    "drift_ks": f"""WITH {_LONG},
vc AS (SELECT feature, num, count_if(side = 'baseline') AS b, count_if(side = 'current') AS c FROM valid GROUP BY ALL),
r AS (
  SELECT feature, sum(b) OVER (PARTITION BY feature ORDER BY num) AS cb, sum(c) OVER (PARTITION BY feature ORDER BY num) AS cc,
         sum(b) OVER (PARTITION BY feature) AS nb, sum(c) OVER (PARTITION BY feature) AS nc FROM vc
), d AS (SELECT feature, max(abs(cb / nb - cc / nc)) AS dd, max(nb) AS nb, max(nc) AS nc FROM r GROUP BY feature),
l AS (SELECT *, dd * sqrt(nb * nc / (nb + nc)) AS lam FROM d)
SELECT feature, round(dd, 6) AS ks_statistic,
       round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
             lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * lam * lam))))) END, 6) AS p_value,
       CAST(nb AS BIGINT) AS n_baseline, CAST(nc AS BIGINT) AS n_current
FROM l""",
    "drift_chi2": f"""WITH {_LONG},
c AS (SELECT feature, cat, count_if(side = 'baseline') AS b, count_if(side = 'current') AS c FROM cats GROUP BY ALL),
t AS (SELECT feature, sum(b) AS nb, sum(c) AS nc, count(*) AS k FROM c GROUP BY feature),
x AS (SELECT c.*, nb, nc, k, nb * (b + c) / (nb + nc) AS eb, nc * (b + c) / (nb + nc) AS ec FROM c JOIN t USING (feature))
SELECT feature,
       round(sum(pow(b + CASE WHEN k = 2 THEN sign(eb - b) * least(0.5, abs(eb - b)) ELSE 0 END - eb, 2) / eb
               + pow(c + CASE WHEN k = 2 THEN sign(ec - c) * least(0.5, abs(ec - c)) ELSE 0 END - ec, 2) / ec), 6) AS chi2_statistic,
       CAST(max(k) - 1 AS INTEGER) AS dof, CAST(max(k) AS INTEGER) AS n_categories
FROM x GROUP BY feature""",
}

# p of chi-square: exp(-x/2) for 2 degrees of freedom; erfc(sqrt(x/2)) by its series for 1 (below 5e-7 beyond 26)
ORACLE["drift_check"] = f"""WITH psi AS ({ORACLE['drift_psi']}), ks AS ({ORACLE['drift_ks']}), chi AS ({ORACLE['drift_chi2']}),
sizes AS (SELECT feature, count(*) FILTER (WHERE side = 'baseline') AS nb, count(*) FILTER (WHERE side = 'current') AS nc
          FROM (WITH {_LONG} SELECT * FROM cats) GROUP BY feature),
t AS (
  SELECT feature, 'ks' AS statistical_test, ks_statistic AS statistic, p_value, n_baseline AS nb, n_current AS nc FROM ks
  UNION ALL
  SELECT feature, 'chi2', chi2_statistic,
         CASE WHEN n_categories < 2 THEN 1.0 WHEN dof = 2 THEN exp(-chi2_statistic / 2) WHEN chi2_statistic > 26 THEN 0.0
              ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60), lambda n: pow(-1.0, n)
                   * pow(sqrt(chi2_statistic / 2), 2 * n + 1) / (exp(lgamma(n + 1.0)) * (2 * n + 1)))) END, nb, nc
  FROM chi JOIN sizes USING (feature)
)
SELECT feature, feature_type, psi, statistical_test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
       CASE WHEN psi >= 0.25 OR p_value < 0.01 THEN 'stop' WHEN psi >= 0.1 OR p_value < 0.05 THEN 'flag' ELSE 'pass' END AS verdict,
       CAST(nb AS BIGINT) AS sample_size_baseline, CAST(nc AS BIGINT) AS sample_size_current
FROM psi JOIN t USING (feature)"""

ORACLE["drift_override"] = ORACLE["drift_psi"].replace(
    "UNION ALL SELECT side, 'l_tax', l_tax FROM li",
    "UNION ALL SELECT side, 'l_tax', l_tax FROM li WHERE side = 'baseline'"
    " UNION ALL SELECT 'current', 'l_tax', value / 1000 FROM events WHERE value IS NOT NULL")
ORACLE["drift_baseline"] = """
WITH s AS (SELECT l_quantity, l_discount, 0.02 * l_quantity - l_discount AS score FROM lineitem
           ORDER BY md5(l_orderkey || '-' || l_linenumber || ':42'), l_orderkey || '-' || l_linenumber LIMIT 10000)
SELECT feature, count(num) AS n, round(avg(num), 6) AS mean, round(max(num), 6) AS largest
FROM (SELECT 'l_quantity' AS feature, CAST(l_quantity AS DOUBLE) AS num FROM s
      UNION ALL SELECT 'l_discount', l_discount FROM s UNION ALL SELECT 'score', score FROM s) GROUP BY feature"""
