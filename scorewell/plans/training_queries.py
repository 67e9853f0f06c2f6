"""Fixture queries of balancing, tree training, tuning and tree attribution."""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.functions.columns import r6
from scorewell.operators import explain as E
from scorewell.operators import models as MD
from scorewell.operators.booster import HistogramBooster, HistogramBoosterModel, histograms, split_gains
from scorewell.operators.neighbours import nearest_neighbours
from scorewell.operators.sampling import kfold
from scorewell.operators.search import adaptive_search as search
from scorewell.operators.smote import smote as oversample
from scorewell.operators.trees import tree_attribution as attribute
from scorewell.plans.tables import table

# Fixed values of the fixture: status P is the minority class, priced in thousands.
SMOTE_FEATURES = ["price", "day", "priority"]


def _open_orders(spark, sf_dir) -> DataFrame:
    od = table(spark, sf_dir, "orders")
    return od.select("o_orderkey", (F.col("o_orderstatus") == "P").cast("int").alias("y"),
                     F.floor(F.col("o_totalprice") / 1000).cast("double").alias("price"),
                     F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("day"),
                     F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"))


def nearest_orders(spark, sf_dir):
    """Exact 5 nearest neighbours among the orders of the minority class."""
    n = nearest_neighbours(_open_orders(spark, sf_dir).where("y = 1"), "o_orderkey", SMOTE_FEATURES, 5)
    return n.select("o_orderkey", "rank", "neighbour", r6("distance").alias("distance"))


def smote(spark, sf_dir):
    """Orders with synthetic rows of the minority class up to parity."""
    out = oversample(_open_orders(spark, sf_dir), "y", "o_orderkey", SMOTE_FEATURES)
    return out.select("o_orderkey", "y", "draw", *[r6(c).alias(c) for c in SMOTE_FEATURES])


# Fixed values of the fixture: the booster's features, and one tree's attribution.
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _lines(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     *[F.col(c).cast("double").alias(c) for c in LINE_FEATURES])


def booster_first_split(spark, sf_dir):
    """M1: gain of every candidate of the first split, from one grouped histogram."""
    vec = VectorAssembler(inputCols=LINE_FEATURES, outputCol="features")
    booster = HistogramBooster(labelCol="y", maxBins=256)
    binned, cuts = booster._binned(vec.transform(_lines(spark, sf_dir)))
    r = binned.agg(F.avg("y").alias("p")).first()
    base = math.log(r["p"] / (1 - r["p"]))
    gains = split_gains(histograms(binned, [], [{}], [0], base, len(cuts), 256))
    points = spark.createDataFrame([(f, i, float(c)) for f, x in enumerate(cuts) for i, c in enumerate(x)], "feature int, bin int, threshold double")
    out = gains.join(F.broadcast(points), ["feature", "bin"])  # at most 255 points per feature
    return out.select(F.element_at(F.array(*[F.lit(c) for c in LINE_FEATURES]), F.col("feature") + 1).alias("feature"), "threshold",
                      F.col("n_left").cast("bigint").alias("n_left"), F.round("gain", 4).alias("gain"))


#: a fixed tree in the booster's form: (feature, threshold) nodes with the rows that reached them
FIXED_TREE = {"base": 0.0, "cuts": [[], [], []], "trees": [[
    {"feature": 0, "threshold": 25.0, "left": 1, "right": 2, "cover": 997}, {"feature": 1, "threshold": 0.04, "left": 3, "right": 4, "cover": 401},
    {"feature": 2, "threshold": 0.05, "left": 5, "right": 6, "cover": 596}, {"value": -1.0, "cover": 103}, {"value": 0.5, "cover": 298},
    {"value": 0.25, "cover": 149}, {"value": 2.0, "cover": 447}]]}


def tree_attribution(spark, sf_dir):
    """Shapley values of a fixed tree for every line, and mean |phi| weights of an ensemble with a linear model."""
    x = _lines(spark, sf_dir)
    x = attribute(x, "row_id", LINE_FEATURES, HistogramBoosterModel(json.dumps(FIXED_TREE)), prefix="tree_")
    x = E.linear_attribution(x, "row_id", {"l_quantity": 0.02, "l_discount": -3.0, "l_tax": 2.0}, {"l_quantity": 25.0, "l_discount": 0.05, "l_tax": 0.04}, prefix="line_")
    both = E.ensemble_columns(x, "row_id", LINE_FEATURES, {"tree_": 3.0, "line_": 1.0})
    return both.select("row_id", "feature", r6("phi").alias("phi"))


def adaptive_search(spark, sf_dir):
    """M5: adaptive search of a logistic model's penalty over three folds of the lines."""
    folds = kfold(_lines(spark, sf_dir), "y", "row_id", k=3).select(*LINE_FEATURES, "y", "fold")  # what is cached and fitted
    make = lambda **p: LogisticRegression(featuresCol="features", labelCol="y", maxIter=10, **p)
    return search(folds, LINE_FEATURES, make, {"regParam": (1e-4, 1.0, "log"), "elasticNetParam": (0.0, 1.0)}, trials=8, startup=4, parallel=4)


def random_search(spark, sf_dir):
    """M5: seeded random search on the same folds and ranges."""
    folds = kfold(_lines(spark, sf_dir), "y", "row_id", k=3).select(*LINE_FEATURES, "y", "fold")  # what is cached and fitted
    make = lambda **p: LogisticRegression(featuresCol="features", labelCol="y", maxIter=10, **p)
    return MD.random_search(folds, LINE_FEATURES, make, {"regParam": (1e-4, 1.0, "log"), "elasticNetParam": (0.0, 1.0)}, trials=4)


QUERIES = {"nearest_orders": nearest_orders, "smote": smote, "booster_first_split": booster_first_split, "tree_attribution": tree_attribution,
           "adaptive_search": adaptive_search, "random_search": random_search}

_ORDERS = """d AS (
  SELECT o_orderkey, CAST(o_orderstatus = 'P' AS INTEGER) AS y, floor(o_totalprice / 1000) AS price,
         CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS day, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority
  FROM orders
), m AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS at FROM d WHERE y = 1),
near AS (
  SELECT a.o_orderkey, b.o_orderkey AS neighbour,
         (a.price - b.price) * (a.price - b.price) + (a.day - b.day) * (a.day - b.day) + (a.priority - b.priority) * (a.priority - b.priority) AS d2,
         row_number() OVER (PARTITION BY a.o_orderkey ORDER BY d2, b.o_orderkey) AS rank
  FROM m a JOIN m b ON a.o_orderkey <> b.o_orderkey QUALIFY rank <= 5
)"""


def _draw(what: str) -> str:
    return f"CAST('0x' || substr(md5('42:' || i || ':{what}'), 1, 13) AS BIGINT)"


ORACLE = {
    "nearest_orders": f"""WITH {_ORDERS}
SELECT o_orderkey, CAST(rank AS INTEGER) AS rank, neighbour, round(sqrt(d2), 6) AS distance FROM near""",
    "smote": f"""WITH {_ORDERS},
size AS (SELECT count(*) FILTER (WHERE y = 0) - count(*) FILTER (WHERE y = 1) AS n, count(*) FILTER (WHERE y = 1) AS few FROM d),
draws AS (SELECT i, {_draw('base')} % few AS at, 1 + {_draw('neighbour')} % 5 AS rank, {_draw('gap')} / 4503599627370496.0::DOUBLE AS gap
          FROM (SELECT unnest(range(n)) AS i, few FROM size)),
new AS (
  SELECT NULL AS o_orderkey, 1 AS y, draws.i AS draw, a.price + gap * (b.price - a.price) AS price, a.day + gap * (b.day - a.day) AS day,
         a.priority + gap * (b.priority - a.priority) AS priority
  FROM draws JOIN m a ON a.at = draws.at JOIN near ON near.o_orderkey = a.o_orderkey AND near.rank = draws.rank
  JOIN m b ON b.o_orderkey = near.neighbour
), both_ AS (SELECT o_orderkey, y, NULL AS draw, price, day, priority FROM d UNION ALL SELECT * FROM new)
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, y, CAST(draw AS BIGINT) AS draw, round(price, 6) AS price, round(day, 6) AS day,
       round(priority, 6) AS priority FROM both_""",
    "booster_first_split": """
WITH l AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, unnest([{'f': 'l_quantity', 'v': CAST(l_quantity AS DOUBLE)},
             {'f': 'l_discount', 'v': CAST(l_discount AS DOUBLE)}, {'f': 'l_tax', 'v': CAST(l_tax AS DOUBLE)}]) AS u FROM lineitem),
p AS (SELECT avg(CAST(l_returnflag = 'R' AS INTEGER)) AS p FROM lineitem),
c AS (SELECT u.f AS feature, u.v AS threshold, sum(p.p - y) AS g, sum(p.p * (1 - p.p)) AS h, count(*) AS n FROM l, p GROUP BY ALL),
r AS (SELECT feature, threshold, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER a AS ga, sum(h) OVER a AS ha, sum(n) OVER a AS na
      FROM c WINDOW w AS (PARTITION BY feature ORDER BY threshold), a AS (PARTITION BY feature))
SELECT feature, threshold, CAST(nl AS BIGINT) AS n_left,
       round(0.5 * (gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)), 4) AS gain FROM r WHERE nl < na""",
    "tree_attribution": """
WITH x AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id, CAST(l_quantity AS DOUBLE) AS q, CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS t FROM lineitem),
leaves(v, second, zq, zs, low_q, low_s) AS (VALUES (-1.0::DOUBLE, 'd', 401::DOUBLE / 997, 103::DOUBLE / 401, true, true), (0.5, 'd', 401::DOUBLE / 997, 298::DOUBLE / 401, true, false),
                                                  (0.25, 't', 596::DOUBLE / 997, 149::DOUBLE / 596, false, true), (2.0, 't', 596::DOUBLE / 997, 447::DOUBLE / 596, false, false)),
o AS (SELECT row_id, v, second, zq, zs, CAST((q <= 25) = low_q AS INTEGER) AS oq,
             CAST((CASE second WHEN 'd' THEN d <= 0.04 ELSE t <= 0.05 END) = low_s AS INTEGER) AS os FROM x, leaves),
s AS (SELECT row_id, sum(v * (oq - zq) * (os + zs) / 2) AS fq, sum(CASE WHEN second = 'd' THEN v * (os - zs) * (oq + zq) / 2 ELSE 0 END) AS fd,
             sum(CASE WHEN second = 't' THEN v * (os - zs) * (oq + zq) / 2 ELSE 0 END) AS ft FROM o GROUP BY row_id)
SELECT row_id, 'l_quantity' AS feature, round(0.75 * fq + 0.25 * 0.02 * (q - 25), 6) AS phi FROM s JOIN x USING (row_id)
UNION ALL SELECT row_id, 'l_discount', round(0.75 * fd + 0.25 * -3.0 * (d - 0.05), 6) FROM s JOIN x USING (row_id)
UNION ALL SELECT row_id, 'l_tax', round(0.75 * ft + 0.25 * 2.0 * (t - 0.04), 6) FROM s JOIN x USING (row_id)""",
}
