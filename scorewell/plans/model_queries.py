"""Fixture queries: soft voting, weight search, promotion, selection, parity, splits,
explanation gates — over fixed linear scores of lineitem (``y = l_returnflag = 'R'``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.columns import r6
from scorewell.operators import explain as E
from scorewell.operators import metrics as M
from scorewell.operators import models as MD
from scorewell.operators import sampling as S
from scorewell.plans.tables import table
from scorewell.session import staged

# Fixed values of the fixtures: three linear "models" and the attribution weights.
PROBS = ["p1", "p2", "p3"]
ATTR_WEIGHTS = {"l_quantity": 0.8, "l_extendedprice": 0.00002, "l_discount": -3.0, "l_tax": 2.0,
                "l_returnflag_N": -0.5, "l_returnflag_R": 0.7}
ATTR_WEIGHTS_B = {"l_quantity": 0.5, "l_extendedprice": 0.00003, "l_discount": -2.0, "l_tax": 3.0,
                  "l_returnflag_N": -0.4, "l_returnflag_R": 0.9}
ATTR_WEIGHTS_C = {"l_quantity": 1.0, "l_extendedprice": 0.00001, "l_discount": -4.0, "l_tax": 1.0,
                  "l_returnflag_N": -0.6, "l_returnflag_R": 0.5}
PARENTS = ["l_returnflag"]
EXPECTED = ["l_quantity", "l_discount", "l_returnflag"]
EXPECTED_GATE2 = ["l_quantity", "l_discount", "l_returnflag", "l_shipmode"]
UNWANTED = ["l_tax"]
EXPECTED_SIGN = {"l_quantity": 1, "l_discount": -1, "l_tax": 1}


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     (F.col("l_discount") * 10).alias("p1"), (F.col("l_tax") / 0.08).alias("p2"),
                     ((F.col("l_quantity") - 1) / 49).alias("p3"))


def soft_vote(spark, sf_dir):
    """M3: weighted soft vote [5, 3, 1] and its ROC-AUC / average precision."""
    s = scores(spark, sf_dir).withColumn("score", MD.soft_vote(PROBS, MD.ENSEMBLE_WEIGHTS)) \
        .withColumn("model", F.lit("vote_5_3_1"))
    pts = M.curve(s, ["model"])
    out = M.roc_auc(None, ["model"], points=pts).join(M.average_precision(None, ["model"], points=pts), "model")
    return out.select("model", r6("roc_auc").alias("roc_auc"), r6("average_precision").alias("average_precision"))


def weight_search(spark, sf_dir):
    """M5: average precision of every weight triple on 1..5 in one job."""
    w = MD.weight_search(scores(spark, sf_dir), PROBS)
    return w.select("w1", "w2", "w3", r6("average_precision").alias("average_precision"))


def promotion_check(spark, sf_dir):
    """Champion p1 vs candidate p2 at 0.5."""
    p = MD.promotion_check(scores(spark, sf_dir), "p1", "p2", 0.5)
    return p.select("n", "champion_invalid", "candidate_invalid", r6("champion_rate_pct").alias("champion_rate_pct"),
                    r6("candidate_rate_pct").alias("candidate_rate_pct"), r6("rate_diff_pct").alias("rate_diff_pct"),
                    F.col("mandatory_pass").cast("int").alias("mandatory_pass"),
                    F.col("advisory_pass").cast("int").alias("advisory_pass"))


def model_rank(spark, sf_dir):
    """PR-AUC on two splits and recall; filter and rank the candidates."""
    s = scores(spark, sf_dir).withColumn("p_vote", MD.soft_vote(PROBS, MD.ENSEMBLE_WEIGHTS))
    long = s.select("y", F.when(F.col("l_linenumber") <= 3, "val").otherwise("test").alias("split"),
                    F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score"))
                                        for m in ["p1", "p2", "p3", "p_vote"]])).alias("m")) \
        .select("y", "split", "m.model", "m.score")
    ap = M.average_precision(long, ["model", "split"])
    wide = ap.groupBy("model").agg(
        F.max(F.when(F.col("split") == "val", F.col("average_precision"))).alias("pr_auc_val"),
        F.max(F.when(F.col("split") == "test", F.col("average_precision"))).alias("pr_auc_test"))
    rec = M.confusion(long.where(F.col("split") == "test"), ["model"], 0.3).select("model", "recall")
    r = MD.rank_models(wide.join(rec, "model"))
    return r.select("model", r6("pr_auc_val").alias("pr_auc_val"), r6("pr_auc_test").alias("pr_auc_test"),
                    r6("recall").alias("recall"), F.col("passed").cast("int").alias("passed"), "rank")


def _orders_versions(spark, sf_dir):
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    b = (od.where(F.col("o_orderpriority") != "3-MEDIUM")
         .withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") * (1 + 5e-7))
                     .when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 0.01)
                     .otherwise(F.col("o_totalprice")))
         .withColumn("o_orderstatus", F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "F"),
                                             F.lit("X")).otherwise(F.col("o_orderstatus"))))
    return od, b


def parity_compare(spark, sf_dir):
    """Two derived versions of orders compared on the key within rtol 1e-6 / atol 1e-8."""
    a, b = _orders_versions(spark, sf_dir)
    p = MD.parity_compare(a, b, "o_orderkey", ["o_totalprice"], ["o_orderstatus"])
    return p.select("column", "n_compared", "n_mismatch", r6("max_abs_diff").alias("max_abs_diff"))


def _labelled_orders(spark, sf_dir):
    """Orders with their status as label; status P counts as unlabelled."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))


def stratified_split(spark, sf_dir):
    """B1: 70 / 15 / 15 per order status (no label: a class of its own)."""
    od = _labelled_orders(spark, sf_dir)
    return S.stratified_split(od, "o_orderstatus", "o_orderkey", seed=42).select("o_orderkey", "o_orderstatus", "split")


def kfold(spark, sf_dir):
    """B2: stratified 3-fold."""
    od = _labelled_orders(spark, sf_dir)
    return S.kfold(od, "o_orderstatus", "o_orderkey", k=3, seed=42).select("o_orderkey", "o_orderstatus", "fold")


def _attr_input(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"), "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax",
                     (F.col("l_returnflag") == "N").cast("int").alias("l_returnflag_N"),
                     (F.col("l_returnflag") == "R").cast("int").alias("l_returnflag_R"))


def _attributions(spark, sf_dir, weights):
    x = _attr_input(spark, sf_dir)
    means = E.background_means(x, list(weights))
    return E.linear_attribution(x, "row_id", weights, means)


def importance_top_n(spark, sf_dir):
    """E1 + A21 + A22 + K5: mean |phi| per feature, max per parent, top 5."""
    imp = E.parent_importance(E.mean_abs(_attributions(spark, sf_dir, ATTR_WEIGHTS)), PARENTS)
    t = E.top_n(imp, "parent", 5)
    return t.select("parent", r6("importance").alias("importance"), "rank")


def direction_gate(spark, sf_dir):
    """E5 (gate 1): Spearman of value and phi per feature against the expected sign."""
    d = E.direction(_attributions(spark, sf_dir, ATTR_WEIGHTS), EXPECTED_SIGN, "spearman")
    return d.select("feature", r6("corr").alias("corr"), F.col("checked").cast("int").alias("checked"),
                    F.col("correct").cast("int").alias("correct"))


def scorecard(spark, sf_dir):
    """E4-E8 (gate 1): relevance of the top 10 parents, direction, magnitude of the top
    10 features, consistency of three rankings -> score, trials."""
    attr = _attributions(spark, sf_dir, ATTR_WEIGHTS)
    raw = staged(E.mean_abs(attr), "importance")  # a row per feature, read by every check below
    rel = E.relevance(E.top_n(E.parent_importance(raw, PARENTS), "parent", 10), "parent", EXPECTED)
    mag = E.magnitude(E.top_n(raw, "feature", 10))
    dirv = E.direction_verdict(E.direction(attr, EXPECTED_SIGN, "spearman"))
    con = E.consistency(raw, *[staged(E.mean_abs(_attributions(spark, sf_dir, w)), "importance") for w in (ATTR_WEIGHTS_B, ATTR_WEIGHTS_C)])
    one = rel.crossJoin(mag).crossJoin(dirv).crossJoin(con)  # one-row aggregates
    score, trials = E.scorecard(F.col("relevance_pass"), F.col("direction_pass"), F.col("magnitude_pass"), F.col("consistency_pass"))
    return one.select(r6("relevance").alias("relevance"), F.col("relevance_pass").cast("int").alias("relevance_pass"),
                      r6("dominance").alias("dominance"), r6("cv").alias("cv"),
                      F.col("magnitude_pass").cast("int").alias("magnitude_pass"),
                      F.col("direction_pass").cast("int").alias("direction_pass"),
                      F.col("consistency_pass").cast("int").alias("consistency_pass"),
                      score.alias("score"), trials.alias("trials"))


def gate2_verdict(spark, sf_dir):
    """E8 (gate 2): prefix overlap on two rankings (the second weight set stands in for
    a permutation table), unwanted features, Pearson directions; and without a
    permutation table, as for an ensemble."""
    attr = _attributions(spark, sf_dir, ATTR_WEIGHTS)
    second = staged(E.mean_abs(_attributions(spark, sf_dir, ATTR_WEIGHTS_B)), "importance")
    rows = [E.gate2(attr, p, EXPECTED_GATE2, UNWANTED, EXPECTED_SIGN, n_top=4, n_garbage=3).withColumn("model", F.lit(m))
            for m, p in (("single", second), ("ensemble", None))]
    out = rows[0].unionByName(rows[1])
    return out.select("model", r6("attribution_overlap").alias("attribution_overlap"), r6("permutation_overlap").alias("permutation_overlap"),
                      *[F.col(c).cast("int").alias(c) for c in ("attribution_pass", "permutation_pass", "garbage_pass", "direction_pass", "all_pass")])


def ranking_consistency(spark, sf_dir):
    """Mean pairwise Spearman of three importance rankings (three weight sets)."""
    r = [staged(E.mean_abs(_attributions(spark, sf_dir, w)), "importance") for w in (ATTR_WEIGHTS, ATTR_WEIGHTS_B, ATTR_WEIGHTS_C)]
    c = E.consistency(*r)
    return c.select(r6("consistency").alias("consistency"),
                    F.col("consistency_pass").cast("int").alias("consistency_pass"))


def permutation_importance(spark, sf_dir):
    """PR-AUC drop of the [5, 3, 1] vote when one input column is shuffled (5 repeats)."""
    li = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount", "l_tax", "l_quantity")

    def score_fn(d):
        return d.withColumn("score", MD.soft_vote([F.col("l_discount") * 10, F.col("l_tax") / 0.08,
                                                   (F.col("l_quantity") - 1) / 49], MD.ENSEMBLE_WEIGHTS))
    p = E.permutation_importance(li, "row_id", "y", ["l_discount", "l_tax", "l_quantity"], score_fn, repeats=5)
    return p.select("feature", r6("importance_mean").alias("importance_mean"),
                    r6("importance_std").alias("importance_std"))


def hash_sample(spark, sf_dir):
    """1,000 seeded rows of lineitem without replacement (a sampling operator)."""
    li = table(spark, sf_dir, "lineitem").withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    return S.hash_sample(li, 1000, "row_id", seed=42).select("row_id", "l_quantity", "l_returnflag")


def class_weights(spark, sf_dir):
    """Balanced class weights per return flag class; sum of weights per class."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"))
    w = S.class_weights(li, "y")
    return w.groupBy("y").agg(F.count(F.lit(1)).alias("n"), r6(F.first("weight")).alias("weight"),
                              r6(F.sum("weight")).alias("weight_sum"))


QUERIES = {
    "soft_vote": soft_vote, "weight_search": weight_search, "promotion_check": promotion_check,
    "model_rank": model_rank, "parity_compare": parity_compare, "stratified_split": stratified_split,
    "kfold": kfold, "importance_top_n": importance_top_n, "direction_gate": direction_gate,
    "scorecard": scorecard, "gate2_verdict": gate2_verdict, "ranking_consistency": ranking_consistency,
    "permutation_importance": permutation_importance, "hash_sample": hash_sample,
    "class_weights": class_weights,
}

_SC = """s AS (
  SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount * 10 AS p1, l_tax / 0.08 AS p2,
         (l_quantity - 1) / 49 AS p3 FROM lineitem
)"""


def _ap_sql(src: str, keys: str) -> str:
    """Average precision per key over ``src(keys, y, score)`` (CTE text)."""
    return f"""sc AS (
  SELECT {keys}, score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
  FROM {src} WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY ALL
), pts AS (
  SELECT {keys}, pos, neg, sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC) AS tp,
         sum(neg) OVER (PARTITION BY {keys} ORDER BY score DESC) AS fp,
         sum(pos) OVER (PARTITION BY {keys}) AS n_pos, sum(neg) OVER (PARTITION BY {keys}) AS n_neg FROM sc
), ap AS (
  SELECT {keys}, CASE WHEN max(n_pos) > 0 THEN sum(pos / n_pos * (tp / (tp + fp))) END AS average_precision,
         CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (2 * tp - pos)) / (2.0 * max(n_pos) * max(n_neg)) END AS roc_auc
  FROM pts GROUP BY ALL
)"""


_ATTR = """x AS (
  SELECT l_orderkey || '-' || l_linenumber AS row_id, CAST(l_quantity AS DOUBLE) AS l_quantity, l_extendedprice, l_discount, l_tax,
         CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N, CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R
  FROM lineitem
), m AS (
  SELECT avg(l_quantity) AS q, avg(l_extendedprice) AS e, avg(l_discount) AS d, avg(l_tax) AS t,
         avg(l_returnflag_N) AS n, avg(l_returnflag_R) AS r FROM x
)"""


def _attr_long(w: dict, name: str) -> str:
    return f"""{name} AS (
  SELECT row_id, 'l_quantity' AS feature, l_quantity AS value, {w['l_quantity']} * (l_quantity - q) AS phi FROM x, m
  UNION ALL SELECT row_id, 'l_extendedprice', l_extendedprice, {w['l_extendedprice']} * (l_extendedprice - e) FROM x, m
  UNION ALL SELECT row_id, 'l_discount', l_discount, {w['l_discount']} * (l_discount - d) FROM x, m
  UNION ALL SELECT row_id, 'l_tax', l_tax, {w['l_tax']} * (l_tax - t) FROM x, m
  UNION ALL SELECT row_id, 'l_returnflag_N', CAST(l_returnflag_N AS DOUBLE), {w['l_returnflag_N']} * (l_returnflag_N - n) FROM x, m
  UNION ALL SELECT row_id, 'l_returnflag_R', CAST(l_returnflag_R AS DOUBLE), {w['l_returnflag_R']} * (l_returnflag_R - r) FROM x, m
)"""


_IMP = """imp AS (
  SELECT CASE WHEN feature LIKE 'l_returnflag\\_%' ESCAPE '\\' THEN 'l_returnflag' ELSE feature END AS parent,
         max(importance) AS importance
  FROM (SELECT feature, avg(abs(phi)) AS importance FROM a GROUP BY feature) GROUP BY 1
), ranked AS (SELECT *, row_number() OVER (ORDER BY importance DESC, parent) AS rank FROM imp)"""

_DIR = """d0 AS (SELECT * FROM a WHERE feature IN ('l_quantity', 'l_discount', 'l_tax') AND value IS NOT NULL AND phi IS NOT NULL),
dr AS (
  SELECT feature, value, phi,
         rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY feature ORDER BY phi) + (count(*) OVER (PARTITION BY feature, phi) - 1) / 2.0 AS ry
  FROM d0
), dir AS (
  SELECT feature, corr(rx, ry) AS c FROM dr GROUP BY feature
), dir2 AS (
  SELECT feature, c, c IS NOT NULL AS checked,
         c IS NOT NULL AND sign(c) = CASE feature WHEN 'l_quantity' THEN 1 WHEN 'l_discount' THEN -1 WHEN 'l_tax' THEN 1 END AS correct
  FROM dir
)"""

_POSITIONS = """p AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, count(*) OVER (PARTITION BY nullif(o_orderstatus, 'P')) AS n,
         row_number() OVER (PARTITION BY nullif(o_orderstatus, 'P') ORDER BY substr(md5(o_orderkey || ':42'), 1, 15), o_orderkey) - 1 AS pos FROM orders)"""

ORACLE = {
    "soft_vote": f"""WITH {_SC}, v AS (SELECT 'vote_5_3_1' AS model, y, (p1 * 5.0 + p2 * 3.0 + p3 * 1.0) / 9.0 AS score FROM s),
{_ap_sql('v', 'model')}
SELECT model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision FROM ap""",
    "weight_search": f"""WITH {_SC}, g AS (
  SELECT a.w AS w1, b.w AS w2, c.w AS w3 FROM range(1, 6) a(w), range(1, 6) b(w), range(1, 6) c(w)
), v AS (SELECT w1, w2, w3, y, (p1 * w1 + p2 * w2 + p3 * w3) / (w1 + w2 + w3) AS score FROM s, g),
{_ap_sql('v', 'w1, w2, w3')}
SELECT CAST(w1 AS INTEGER) AS w1, CAST(w2 AS INTEGER) AS w2, CAST(w3 AS INTEGER) AS w3,
       round(average_precision, 6) AS average_precision FROM ap""",
    "promotion_check": f"""WITH {_SC}, a AS (
  SELECT count(*) AS n,
         CAST(count_if(p1 IS NULL OR isnan(p1) OR p1 < 0 OR p1 > 1) AS BIGINT) AS champion_invalid,
         CAST(count_if(p2 IS NULL OR isnan(p2) OR p2 < 0 OR p2 > 1) AS BIGINT) AS candidate_invalid,
         100.0 * avg(CASE WHEN p1 >= 0.5 THEN 1.0 ELSE 0.0 END) AS cr, 100.0 * avg(CASE WHEN p2 >= 0.5 THEN 1.0 ELSE 0.0 END) AS kr
  FROM s
)
SELECT n, champion_invalid, candidate_invalid, round(cr, 6) AS champion_rate_pct, round(kr, 6) AS candidate_rate_pct,
       round(abs(kr - cr), 6) AS rate_diff_pct, CAST(candidate_invalid = 0 AS INTEGER) AS mandatory_pass,
       CAST(abs(kr - cr) < 20.0 AS INTEGER) AS advisory_pass FROM a""",
    "model_rank": f"""WITH {_SC}, long AS (
  SELECT y, CASE WHEN l_linenumber <= 3 THEN 'val' ELSE 'test' END AS split, m.model, m.score FROM (
    SELECT *, unnest([{{'model': 'p1', 'score': p1}}, {{'model': 'p2', 'score': p2}}, {{'model': 'p3', 'score': p3}},
                      {{'model': 'p_vote', 'score': (p1 * 5.0 + p2 * 3.0 + p3 * 1.0) / 9.0}}]) AS m FROM s)
), {_ap_sql('long', 'model, split')},
wide AS (SELECT model, max(average_precision) FILTER (WHERE split = 'val') AS pr_auc_val,
                max(average_precision) FILTER (WHERE split = 'test') AS pr_auc_test FROM ap GROUP BY model),
rec AS (SELECT model, coalesce(count_if(score >= 0.3 AND y = 1) / nullif(count_if(y = 1), 0), 0.0) AS recall
        FROM long WHERE split = 'test' GROUP BY model),
r AS (SELECT wide.*, recall, recall >= 0.75 AND abs(pr_auc_val - pr_auc_test) <= 0.02 AS passed FROM wide JOIN rec USING (model))
SELECT model, round(pr_auc_val, 6) AS pr_auc_val, round(pr_auc_test, 6) AS pr_auc_test, round(recall, 6) AS recall,
       CAST(passed AS INTEGER) AS passed,
       CASE WHEN passed THEN CAST(row_number() OVER (PARTITION BY passed ORDER BY pr_auc_test DESC, recall DESC, model) AS INTEGER) END AS rank
FROM r""",
    "parity_compare": """WITH a AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders),
b AS (
  SELECT o_orderkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * (1 + 5e-7)
              WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderpriority <> '3-MEDIUM'
), j AS (SELECT a.o_totalprice AS ap, b.o_totalprice AS bp, a.o_orderstatus AS ast, b.o_orderstatus AS bst
         FROM a FULL OUTER JOIN b USING (o_orderkey))
SELECT 'o_totalprice' AS "column", count(*) AS n_compared,
       CAST(count_if(NOT (coalesce(abs(ap - bp) <= 1e-8 + 1e-6 * abs(bp), false) OR (ap IS NULL AND bp IS NULL))) AS BIGINT) AS n_mismatch,
       round(max(abs(ap - bp)), 6) AS max_abs_diff FROM j
UNION ALL
SELECT 'o_orderstatus', count(*), CAST(count_if(ast IS DISTINCT FROM bst) AS BIGINT), NULL FROM j""",
    "stratified_split": f"""WITH {_POSITIONS},
s AS (SELECT *, CAST(floor(n * 0.15::DOUBLE + 0.5) AS BIGINT) AS nt FROM p),
s2 AS (SELECT *, CAST(floor((n - nt) * (0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)) + 0.5) AS BIGINT) AS nv FROM s)
SELECT o_orderkey, o_orderstatus, CASE WHEN pos < nt THEN 'test' WHEN pos < nt + nv THEN 'val' ELSE 'train' END AS split FROM s2""",
    "kfold": f"""WITH {_POSITIONS} SELECT o_orderkey, o_orderstatus, CAST(pos % 3 AS INTEGER) AS fold FROM p""",
    "permutation_importance": f"""WITH li AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount AS d, l_tax AS t, CAST(l_quantity AS DOUBLE) AS q FROM lineitem
), o AS (SELECT *, row_number() OVER w AS rn, lag(d) OVER w AS d1, lag(t) OVER w AS t1, lag(q) OVER w AS q1 FROM li, range(5) r(rep)
         WINDOW w AS (PARTITION BY rep ORDER BY substr(md5(row_id || ':42:' || rep), 1, 15), row_id)),
e AS (SELECT rep, arg_max(d, rn) AS d2, arg_max(t, rn) AS t2, arg_max(q, rn) AS q2 FROM o GROUP BY rep),
x AS (SELECT o.rep, y, d, t, q, CASE WHEN rn = 1 THEN d2 ELSE d1 END AS dn, CASE WHEN rn = 1 THEN t2 ELSE t1 END AS tn, CASE WHEN rn = 1 THEN q2 ELSE q1 END AS qn
      FROM o JOIN e USING (rep)),
v AS (SELECT 'l_discount' AS feature, rep, y, dn AS d, t, q FROM x UNION ALL SELECT 'l_tax', rep, y, d, tn, q FROM x
      UNION ALL SELECT 'l_quantity', rep, y, d, t, qn FROM x UNION ALL SELECT '', 0, y, d, t, q FROM li),
z AS (SELECT feature, rep, y, (d * 10 * 5.0 + t / 0.08 * 3.0 + (q - 1) / 49 * 1.0) / 9.0 AS score FROM v),
{_ap_sql('z', 'feature, rep')}, b AS (SELECT average_precision AS base FROM ap WHERE feature = '')
SELECT feature, round(avg(base - average_precision), 6) AS importance_mean, round(stddev_pop(base - average_precision), 6) AS importance_std
FROM ap, b WHERE feature <> '' GROUP BY feature""",
    "importance_top_n": f"""WITH {_ATTR}, {_attr_long(ATTR_WEIGHTS, 'a')}, {_IMP}
SELECT parent, round(importance, 6) AS importance, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5""",
    "direction_gate": f"""WITH {_ATTR}, {_attr_long(ATTR_WEIGHTS, 'a')}, {_DIR}
SELECT feature, round(c, 6) AS corr, CAST(checked AS INTEGER) AS checked, CAST(correct AS INTEGER) AS correct FROM dir2""",
    "scorecard": f"""WITH {_ATTR}, {_attr_long(ATTR_WEIGHTS, 'a')}, {_attr_long(ATTR_WEIGHTS_B, 'a2')}, {_attr_long(ATTR_WEIGHTS_C, 'a3')}, {_IMP}, {_DIR},
want(e) AS (VALUES ('l_quantity'), ('l_discount'), ('l_returnflag')),
rel AS (SELECT count(*) FILTER (WHERE e IN (SELECT parent FROM ranked WHERE rank <= 10)) / count(*) AS relevance FROM want),
feat AS (SELECT feature, avg(abs(phi)) AS importance, row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS rank FROM a GROUP BY feature),
mag AS (SELECT max(importance) FILTER (WHERE rank = 1) AS f, max(importance) FILTER (WHERE rank = 2) AS s,
               stddev_pop(importance) / avg(importance) AS cv FROM feat WHERE rank <= 10),
three AS (
  SELECT feature, avg(abs(phi)) FILTER (WHERE src = 1) AS a, avg(abs(phi)) FILTER (WHERE src = 2) AS b, avg(abs(phi)) FILTER (WHERE src = 3) AS c
  FROM (SELECT 1 AS src, * FROM a UNION ALL SELECT 2, * FROM a2 UNION ALL SELECT 3, * FROM a3) GROUP BY feature),
pairs AS (SELECT 'ab' AS pair, a AS x, b AS y FROM three UNION ALL SELECT 'ac', a, c FROM three UNION ALL SELECT 'bc', b, c FROM three),
pr AS (SELECT pair, rank() OVER (PARTITION BY pair ORDER BY x) + (count(*) OVER (PARTITION BY pair, x) - 1) / 2.0 AS rx,
              rank() OVER (PARTITION BY pair ORDER BY y) + (count(*) OVER (PARTITION BY pair, y) - 1) / 2.0 AS ry FROM pairs),
con AS (SELECT avg(sp) >= 0.7 AS cp FROM (SELECT corr(rx, ry) AS sp FROM pr GROUP BY pair)),
dv AS (SELECT sum(CAST(checked AS INTEGER)) = sum(CAST(correct AS INTEGER)) AS direction_pass FROM dir2),
all1 AS (SELECT relevance, relevance >= 0.5 AS rp, CASE WHEN s = 0 THEN 'inf'::DOUBLE ELSE f / s END AS dominance, cv,
                direction_pass, cp FROM rel, mag, dv, con),
all2 AS (SELECT *, dominance <= 3.0 AND cv >= 0.1 AS mp FROM all1)
SELECT round(relevance, 6) AS relevance, CAST(rp AS INTEGER) AS relevance_pass, round(dominance, 6) AS dominance,
       round(cv, 6) AS cv, CAST(mp AS INTEGER) AS magnitude_pass, CAST(direction_pass AS INTEGER) AS direction_pass,
       CAST(cp AS INTEGER) AS consistency_pass,
       CASE WHEN NOT rp OR NOT direction_pass THEN 3 WHEN mp AND cp THEN 1 ELSE 2 END AS score,
       CASE WHEN NOT rp OR NOT direction_pass THEN 0 WHEN mp AND cp THEN 100 ELSE 30 END AS trials
FROM all2""",
    "gate2_verdict": f"""WITH {_ATTR}, {_attr_long(ATTR_WEIGHTS, 'a')}, {_attr_long(ATTR_WEIGHTS_B, 'a2')},
want(e) AS (VALUES ('l_quantity'), ('l_discount'), ('l_returnflag'), ('l_shipmode')),
t1 AS (SELECT feature, row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS rank FROM a GROUP BY feature),
t2 AS (SELECT feature, row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS rank FROM a2 GROUP BY feature),
o1 AS (SELECT count(*) FILTER (WHERE EXISTS (SELECT 1 FROM t1 WHERE rank <= 4 AND (feature = e OR starts_with(feature, e || '_')))) / count(*) AS v FROM want),
o2 AS (SELECT count(*) FILTER (WHERE EXISTS (SELECT 1 FROM t2 WHERE rank <= 4 AND (feature = e OR starts_with(feature, e || '_')))) / count(*) AS v FROM want),
g AS (SELECT count(*) FILTER (WHERE feature = 'l_tax') = 0 AS ok FROM t1 WHERE rank <= 3),
r AS (SELECT feature, coalesce(corr(value, phi), 0.0) AS c FROM a WHERE feature IN ('l_quantity', 'l_discount', 'l_tax') GROUP BY feature),
d AS (SELECT count(*) FILTER (WHERE abs(c) > 0.05) AS checked,
             count(*) FILTER (WHERE abs(c) > 0.05 AND sign(c) = CASE feature WHEN 'l_discount' THEN -1 ELSE 1 END) AS correct FROM r),
dv AS (SELECT correct >= greatest(1, round(checked * 2.0 / 3.0)) AS ok FROM d)
SELECT 'single' AS model, round(o1.v, 6) AS attribution_overlap, round(o2.v, 6) AS permutation_overlap,
       CAST(o1.v >= 0.5 AS INTEGER) AS attribution_pass, CAST(o2.v >= 0.5 AS INTEGER) AS permutation_pass,
       CAST(g.ok AS INTEGER) AS garbage_pass, CAST(dv.ok AS INTEGER) AS direction_pass,
       CAST(o1.v >= 0.5 AND o2.v >= 0.5 AND g.ok AND dv.ok AS INTEGER) AS all_pass FROM o1, o2, g, dv
UNION ALL
SELECT 'ensemble', round(o1.v, 6), NULL, CAST(o1.v >= 0.5 AS INTEGER), NULL, CAST(g.ok AS INTEGER), CAST(dv.ok AS INTEGER),
       CAST(o1.v >= 0.5 AND g.ok AND dv.ok AS INTEGER) FROM o1, g, dv""",
    "ranking_consistency": f"""WITH {_ATTR}, {_attr_long(ATTR_WEIGHTS, 'a1')}, {_attr_long(ATTR_WEIGHTS_B, 'a2')},
{_attr_long(ATTR_WEIGHTS_C, 'a3')},
i AS (
  SELECT feature, avg(abs(phi)) FILTER (WHERE src = 1) AS a, avg(abs(phi)) FILTER (WHERE src = 2) AS b,
         avg(abs(phi)) FILTER (WHERE src = 3) AS c
  FROM (SELECT 1 AS src, * FROM a1 UNION ALL SELECT 2, * FROM a2 UNION ALL SELECT 3, * FROM a3) GROUP BY feature
), long AS (
  SELECT 'ab' AS pair, a AS x, b AS y FROM i UNION ALL SELECT 'ac', a, c FROM i UNION ALL SELECT 'bc', b, c FROM i
), r AS (
  SELECT pair, rank() OVER (PARTITION BY pair ORDER BY x) + (count(*) OVER (PARTITION BY pair, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY pair ORDER BY y) + (count(*) OVER (PARTITION BY pair, y) - 1) / 2.0 AS ry FROM long
), s AS (SELECT pair, corr(rx, ry) AS sp FROM r GROUP BY pair)
SELECT round(avg(sp), 6) AS consistency, CAST(avg(sp) >= 0.7 AS INTEGER) AS consistency_pass FROM s""",
    "hash_sample": """SELECT l_orderkey || '-' || l_linenumber AS row_id, l_quantity, l_returnflag FROM lineitem
ORDER BY md5(l_orderkey || '-' || l_linenumber || ':42'), row_id LIMIT 1000""",
    "class_weights": """WITH c AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT sum(n) AS tot, count(*) AS k FROM c)
SELECT y, n, round(tot / (k * n), 6) AS weight, round(n * (tot / (k * n)), 6) AS weight_sum FROM c, t""",
}
