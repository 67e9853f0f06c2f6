"""Fixture queries: validation, feature preparation, quality gate (driver tables).

Each query maps the customer-row operators onto TPC-H-like columns:
``l_quantity`` plays tenure, ``l_tax`` the monthly charge, ``l_discount`` the
total (so zero totals occur), ``o_orderpriority`` the payment method.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorewell.functions.columns import r6
from scorewell.operators import features as FE
from scorewell.operators import quality as Q
from scorewell.operators import validate as V
from scorewell.plans.tables import table

# Fixed values of the fixtures.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LINEITEM_SPEC = FE.PrepSpec(
    total="l_discount", tenure="l_quantity", monthly="l_tax",
    bin_col="l_quantity", auto_col="o_orderpriority", auto_values=("1-URGENT", "2-HIGH"),
    count_cols=("l_returnflag", "l_linestatus", "o_orderstatus"), count_value="F",
    drop=(), structural_cols=("l_returnflag",), structural_map={"R": 1, "A": 0, "N": -1},
    binary_cols=("l_linestatus",), binary_map={"O": 1, "F": 0},
    onehot_cols=(), scale_cols=(),
)
LINEITEM_CONTRACT = V.Contract(
    numeric={"l_quantity": V.Range(1, 50), "l_discount": V.Range(0, 0.1), "l_tax": V.Range(0, None)},
    categories={"l_returnflag": ["R", "A", "N"], "l_linestatus": ["O", "F"]},
)
ORDER_CONTRACT = V.Contract(
    numeric={"o_totalprice": V.Range(0, None, lo_inclusive=False), "c_acctbal": V.Range(0, None)},
    categories={"o_orderstatus": ["O", "F", "P"], "o_orderpriority": PRIORITIES,
                "c_mktsegment": SEGMENTS},
    not_null=["o_orderdate", "o_custkey"],
)


def _lineitem_orders(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def feature_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered features per line (one projection over the join)."""
    out = FE.prepare_unfitted(_lineitem_orders(spark, sf_dir), LINEITEM_SPEC)
    return out.select("l_orderkey", "l_linenumber", r6("tc_residual").alias("tc_residual"),
                      r6("monthly_to_total_ratio").alias("monthly_to_total_ratio"),
                      "tenure_group", "is_auto_payment", "service_count", "has_any_addon",
                      F.col("l_returnflag").alias("returnflag_code"),
                      F.col("l_linestatus").alias("linestatus_code"))


def bin_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> V1 -> P3-P8 -> A2: count and share of each bin and flag on valid rows."""
    good, _ = V.split_valid(_lineitem_orders(spark, sf_dir), LINEITEM_CONTRACT)
    feats = FE.engineer(good, LINEITEM_SPEC)
    agg = feats.groupBy("tenure_group", "is_auto_payment", "has_any_addon").agg(
        F.count(F.lit(1)).alias("n"))
    # the window runs over the aggregated groups only (#bins x 2 x 2 rows)
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return agg.select("tenure_group", "is_auto_payment", "has_any_addon", "n",
                      r6(F.col("n") / total).alias("share"))


def _orders_customer(spark, sf_dir) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return od.join(cu, od.o_custkey == cu.c_custkey, "inner")


def one_hot_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12 + P13: fit sorted categories (first dropped) and population scaling, then transform."""
    df = _orders_customer(spark, sf_dir).select("o_orderkey", "o_orderpriority", "c_mktsegment",
                                                "o_totalprice", "c_acctbal")
    cats = FE.fit_one_hot(df, ["o_orderpriority", "c_mktsegment"])
    sc = FE.fit_scaler(df, ["o_totalprice", "c_acctbal"])
    out = FE.transform_scaler(FE.transform_one_hot(df, cats), sc)
    names = FE.one_hot_names(cats)
    return out.select("o_orderkey", *[F.col(f"`{n}`") for n in names],
                      r6("o_totalprice").alias("o_totalprice"), r6("c_acctbal").alias("c_acctbal"))


def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: violations per (column, rule) over orders joined to customers."""
    return V.violation_counts(_orders_customer(spark, sf_dir), ORDER_CONTRACT)


def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1 split + V6 constraint counts: valid / invalid rows per order status."""
    v = V.violations(_orders_customer(spark, sf_dir), ORDER_CONTRACT)
    return (v.groupBy("o_orderstatus")
            .agg(F.sum((F.size(V.VIOLATIONS) == 0).cast("bigint")).alias("n_valid"),
                 F.sum((F.size(V.VIOLATIONS) > 0).cast("bigint")).alias("n_invalid")))


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: missing values per column and order status."""
    df = table(spark, sf_dir, "orders")
    return V.missing_report(df, ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"],
                            by=["o_orderstatus"])


def quality_gate_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gate run per month of orders against the 7 months before."""
    od = table(spark, sf_dir, "orders").withColumn("run_month", F.date_format("o_orderdate", "yyyy-MM"))
    out = Q.gate_replay(od, "run_month", ["o_totalprice", "o_custkey"], ["o_orderstatus", "o_orderpriority"])
    return out.select("run_month", "row_count", "n_baseline", r6("baseline_mean").alias("baseline_mean"),
                      r6("volume_deviation").alias("volume_deviation"), r6("worst_null").alias("worst_null"),
                      r6("worst_shift").alias("worst_shift"), "volume_verdict", "null_verdict",
                      "category_verdict", "verdict")


QUERIES = {
    "feature_prep": feature_prep,
    "bin_share": bin_share,
    "one_hot_scale": one_hot_scale,
    "validate_rows": validate_rows,
    "validate_split": validate_split,
    "missing_report": missing_report,
    "quality_gate_monthly": quality_gate_monthly,
}

ORACLE = {
    "feature_prep": """
SELECT l_orderkey, l_linenumber,
       round(l_discount - l_quantity * l_tax, 6) AS tc_residual,
       round(coalesce(l_tax / nullif(l_discount, 0), 1.0), 6) AS monthly_to_total_ratio,
       CASE WHEN l_quantity IS NULL OR isnan(l_quantity) OR l_quantity < 0 THEN NULL
            WHEN l_quantity <= 2 THEN 'G1_0_2' WHEN l_quantity <= 18 THEN 'G2_2_18'
            WHEN l_quantity <= 44 THEN 'G3_18_44' WHEN l_quantity <= 72 THEN 'G4_44_72' END AS tenure_group,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_auto_payment,
       (CASE WHEN l_returnflag = 'F' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END
        + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS service_count,
       CASE WHEN (CASE WHEN l_returnflag = 'F' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END
        + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS has_any_addon,
       CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 WHEN 'N' THEN -1 END AS returnflag_code,
       CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS linestatus_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""",
    "bin_share": """
WITH j AS (
  SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, o_orderpriority, o_orderstatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
    AND l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
    AND NOT isnan(l_quantity) AND NOT isnan(l_discount) AND NOT isnan(l_tax)
    AND l_quantity BETWEEN 1 AND 50 AND l_discount BETWEEN 0 AND 0.1 AND l_tax >= 0
    AND l_returnflag IN ('R', 'A', 'N') AND l_linestatus IN ('O', 'F')
), f AS (
  SELECT CASE WHEN l_quantity < 0 THEN NULL WHEN l_quantity <= 2 THEN 'G1_0_2' WHEN l_quantity <= 18 THEN 'G2_2_18'
              WHEN l_quantity <= 44 THEN 'G3_18_44' WHEN l_quantity <= 72 THEN 'G4_44_72' END AS tenure_group,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_auto_payment,
         CASE WHEN (CASE WHEN l_returnflag = 'F' THEN 1 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END
           + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS has_any_addon
  FROM j
), a AS (SELECT tenure_group, is_auto_payment, has_any_addon, count(*) AS n FROM f GROUP BY ALL)
SELECT tenure_group, is_auto_payment, has_any_addon, n, round(n / sum(n) OVER (), 6) AS share FROM a
""",
    "one_hot_scale": """
WITH j AS (SELECT o_orderkey, o_orderpriority, c_mktsegment, o_totalprice, c_acctbal
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS "o_orderpriority_2-HIGH",
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS "o_orderpriority_3-MEDIUM",
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS "o_orderpriority_4-NOT SPECIFIED",
  CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS "o_orderpriority_5-LOW",
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS "c_mktsegment_BUILDING",
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS "c_mktsegment_FURNITURE",
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS "c_mktsegment_HOUSEHOLD",
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS "c_mktsegment_MACHINERY",
  round((o_totalprice - avg(o_totalprice) OVER ()) / coalesce(nullif(stddev_pop(o_totalprice) OVER (), 0), 1), 6) AS o_totalprice,
  round((c_acctbal - avg(c_acctbal) OVER ()) / coalesce(nullif(stddev_pop(c_acctbal) OVER (), 0), 1), 6) AS c_acctbal
FROM j
""",
    "validate_rows": """
WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
v AS (
  SELECT 'o_totalprice' AS "column", 'not_null' AS rule FROM j WHERE o_totalprice IS NULL
  UNION ALL SELECT 'c_acctbal', 'not_null' FROM j WHERE c_acctbal IS NULL
  UNION ALL SELECT 'o_orderstatus', 'not_null' FROM j WHERE o_orderstatus IS NULL
  UNION ALL SELECT 'o_orderpriority', 'not_null' FROM j WHERE o_orderpriority IS NULL
  UNION ALL SELECT 'c_mktsegment', 'not_null' FROM j WHERE c_mktsegment IS NULL
  UNION ALL SELECT 'o_orderdate', 'not_null' FROM j WHERE o_orderdate IS NULL
  UNION ALL SELECT 'o_custkey', 'not_null' FROM j WHERE o_custkey IS NULL
  UNION ALL SELECT 'o_totalprice', 'type' FROM j WHERE isnan(o_totalprice)
  UNION ALL SELECT 'c_acctbal', 'type' FROM j WHERE isnan(c_acctbal)
  UNION ALL SELECT 'o_totalprice', 'range' FROM j WHERE NOT isnan(o_totalprice) AND o_totalprice <= 0
  UNION ALL SELECT 'c_acctbal', 'range' FROM j WHERE NOT isnan(c_acctbal) AND c_acctbal < 0
  UNION ALL SELECT 'o_orderstatus', 'domain' FROM j WHERE o_orderstatus NOT IN ('O', 'F', 'P')
  UNION ALL SELECT 'o_orderpriority', 'domain' FROM j
     WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
  UNION ALL SELECT 'c_mktsegment', 'domain' FROM j
     WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
)
SELECT "column", rule, count(*) AS n_bad FROM v GROUP BY ALL
""",
    "validate_split": """
WITH j AS (SELECT *, (o_totalprice IS NULL OR isnan(o_totalprice) OR o_totalprice <= 0
                      OR c_acctbal IS NULL OR isnan(c_acctbal) OR c_acctbal < 0
                      OR o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'F', 'P')
                      OR o_orderpriority IS NULL
                      OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
                      OR c_mktsegment IS NULL
                      OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
                      OR o_orderdate IS NULL OR o_custkey IS NULL) AS bad
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderstatus, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS n_valid,
       CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid
FROM j GROUP BY o_orderstatus
""",
    "missing_report": """
SELECT o_orderstatus, "column", n_missing FROM (
  SELECT o_orderstatus,
         CAST(sum(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_custkey,
         CAST(sum(CASE WHEN o_totalprice IS NULL OR isnan(o_totalprice) THEN 1 ELSE 0 END) AS BIGINT) AS o_totalprice,
         CAST(sum(CASE WHEN o_orderdate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_orderdate,
         CAST(sum(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS o_orderpriority
  FROM orders GROUP BY o_orderstatus
) UNPIVOT (n_missing FOR "column" IN (o_custkey, o_totalprice, o_orderdate, o_orderpriority))
""",
    "quality_gate_monthly": """
WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS run_month, * FROM orders),
runs AS (
  SELECT run_month, count(*) AS row_count FROM o GROUP BY run_month
), runs2 AS (
  SELECT *, row_number() OVER w AS run_idx,
         CAST(count(*) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS INTEGER) AS n_baseline,
         avg(row_count) OVER (w ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline_mean
  FROM runs WINDOW w AS (ORDER BY run_month)
), runs3 AS (
  SELECT *, CASE WHEN n_baseline < 3 THEN NULL WHEN baseline_mean = 0 THEN 0.0
                 ELSE abs(row_count - baseline_mean) / baseline_mean END AS volume_deviation
  FROM runs2
), nl AS (
  SELECT run_month, max(p) AS worst_null FROM (
    SELECT run_month, avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END) AS p FROM o GROUP BY 1
    UNION ALL SELECT run_month, avg(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0.0 END) FROM o GROUP BY 1
    UNION ALL SELECT run_month, avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END) FROM o GROUP BY 1
    UNION ALL SELECT run_month, avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) FROM o GROUP BY 1
  ) WHERE p >= 0.01 GROUP BY run_month
), cat AS (
  SELECT run_month, 'o_orderstatus' AS col, o_orderstatus AS val, count(*) AS n FROM o
    WHERE o_orderstatus IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT run_month, 'o_orderpriority', o_orderpriority, count(*) FROM o
    WHERE o_orderpriority IS NOT NULL GROUP BY ALL
), sh AS (
  SELECT c.run_month, col, val, n / sum(n) OVER (PARTITION BY c.run_month, col) AS share, r.run_idx, r.n_baseline
  FROM cat c JOIN runs3 r USING (run_month)
), shift2 AS (
  SELECT t.run_month, max(x) AS worst_shift FROM (
    SELECT t.run_month, abs(t.share - coalesce(sum(b.share), 0) / t.n_baseline) AS x
    FROM sh t LEFT JOIN sh b ON b.col = t.col AND b.val = t.val
         AND b.run_idx BETWEEN t.run_idx - 7 AND t.run_idx - 1
    WHERE t.n_baseline >= 3
    GROUP BY t.run_month, t.col, t.val, t.share, t.n_baseline
  ) t WHERE x >= 0.10 GROUP BY t.run_month
), r AS (
  SELECT runs3.*, worst_null, worst_shift,
    CASE WHEN volume_deviation IS NULL THEN 'pass' WHEN volume_deviation >= 0.5 THEN 'stop'
         WHEN volume_deviation >= 0.2 THEN 'flag' ELSE 'pass' END AS volume_verdict,
    CASE WHEN worst_null IS NULL THEN 'pass' WHEN worst_null >= 0.1 THEN 'stop'
         WHEN worst_null >= 0.01 THEN 'flag' ELSE 'pass' END AS null_verdict,
    CASE WHEN worst_shift IS NULL THEN 'pass' WHEN worst_shift >= 0.3 THEN 'stop'
         WHEN worst_shift >= 0.1 THEN 'flag' ELSE 'pass' END AS category_verdict
  FROM runs3 LEFT JOIN nl USING (run_month) LEFT JOIN shift2 USING (run_month)
)
SELECT run_month, row_count, n_baseline, round(baseline_mean, 6) AS baseline_mean,
       round(volume_deviation, 6) AS volume_deviation, round(worst_null, 6) AS worst_null,
       round(worst_shift, 6) AS worst_shift, volume_verdict, null_verdict, category_verdict,
       CASE WHEN 'stop' IN (volume_verdict, null_verdict, category_verdict) THEN 'stop'
            WHEN 'flag' IN (volume_verdict, null_verdict, category_verdict) THEN 'flag' ELSE 'pass' END AS verdict
FROM r
""",
}
