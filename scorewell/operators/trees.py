"""Attribution of fitted tree models.

A leaf is the product of its path's conditions.  With the features outside a set
unknown, a row reaches it with probability: for known features whether the row's
value meets the path's conditions, for unknown ones the share of training rows
that did.  The Shapley values of such a product have a closed form: each feature's
value is an integral over a polynomial, which Gauss-Legendre nodes give exactly.
So every (row, leaf) is a few array operations, and no feature set is enumerated.

Paths are taken from the fitted model once (their number is the model's size); rows
are attributed where they lie, in blocks, and come out in the long form
``(row, feature, value, phi)`` that every check of ``explain`` reads.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

BLOCK = 4096


@dataclass(frozen=True)
class Path:
    """A leaf: its (weighted) value, and per feature on its path the range ``(low,
    high]`` it asks for and the share of training rows that met it."""
    value: float
    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    share: tuple[float, ...]


def _walk(node, value: float, seen: dict, out: list, kind) -> None:
    split = kind.split(node)
    if split is None:
        f = tuple(sorted(seen))
        out.append(Path(value * kind.value(node), f, *(tuple(seen[j][k] for j in f) for k in range(3))))
        return
    feature, threshold, left, right = split
    for child, lo, hi in ((left, -np.inf, threshold), (right, threshold, np.inf)):
        a, b, z = seen.get(feature, (-np.inf, np.inf, 1.0))
        total = kind.cover(node)
        met = {**seen, feature: (max(a, lo), min(b, hi), z * (kind.cover(child) / total if total else 0.0))}
        _walk(child, value, met, out, kind)


class _SparkNode:
    """Nodes of Spark's tree models."""

    def __init__(self, classify: bool):
        self.classify = classify

    def split(self, n):
        if n.getClass().getSimpleName() == "LeafNode":
            return None
        s = n.split()
        if s.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only splits at a threshold can be attributed")
        return s.featureIndex(), s.threshold(), n.leftChild(), n.rightChild()

    def cover(self, n) -> float:
        return float(n.impurityStats().count())

    def value(self, n) -> float:
        if not self.classify:
            return float(n.prediction())
        stats = list(n.impurityStats().stats())
        return stats[1] / sum(stats)


class _BoosterNode:
    def __init__(self, tree):
        self.tree = tree

    def split(self, n):
        return None if "feature" not in n else (n["feature"], n["threshold"], self.tree[n["left"]], self.tree[n["right"]])

    def cover(self, n) -> float:
        return float(n["cover"])

    def value(self, n) -> float:
        return float(n["value"])


def leaf_paths(model) -> tuple[float, list[Path]]:
    """(constant, leaves) of a fitted model: the sum of the leaves a row reaches, and the
    constant, is the log odds of a booster (half of them for Spark's), the probability
    of a forest or tree."""
    from scorewell.operators.booster import HistogramBoosterModel
    out: list[Path] = []
    if isinstance(model, HistogramBoosterModel):
        s = model.state
        for t in s["trees"]:
            _walk(t[0], 1.0, {}, out, _BoosterNode(t))
        return s["base"], out
    name = type(model).__name__
    kind = _SparkNode(name in ("RandomForestClassificationModel", "DecisionTreeClassificationModel"))
    if name == "DecisionTreeClassificationModel":
        _walk(model._call_java("rootNode"), 1.0, {}, out, kind)
    else:
        share = 1.0 if name == "GBTClassificationModel" else 1.0 / len(model.trees)
        for t, w in zip(model.trees, model.treeWeights):
            _walk(t._call_java("rootNode"), w * share, {}, out, kind)
    return 0.0, out


def expected(constant: float, paths: Sequence[Path]) -> float:
    """The model's mean over its training rows, as its paths' shares give it."""
    return constant + sum(p.value * float(np.prod(p.share)) for p in paths)


def attribute_block(x: np.ndarray, paths: Sequence[Path]) -> np.ndarray:
    """Shapley values (rows, features) of rows of features."""
    phi = np.zeros(x.shape)
    for p in paths:
        m = len(p.features)
        if not m or not p.value:
            continue
        v = x[:, p.features]
        # NaN is above every threshold, as in scoring
        inside = ((v > np.array(p.low)) | np.isneginf(p.low)) & ((v <= np.array(p.high)) | np.isposinf(p.high)) \
            | (np.isnan(v) & np.isposinf(p.high))
        at, weight = np.polynomial.legendre.leggauss((m + 1) // 2)
        share = np.array(p.share)
        total = np.zeros(v.shape)
        for t, w in zip((at + 1) / 2, weight / 2):
            f = np.where(inside, t, 0.0) + share * (1 - t)
            for j in range(m):
                total[:, j] += w * np.prod(np.delete(f, j, axis=1), axis=1)
        phi[:, p.features] += p.value * (inside - share) * total
    return phi


def tree_attribution(df: DataFrame, row_id: str, features: Sequence[str], model, prefix: str | None = None) -> DataFrame:
    """Rows (``row_id``, feature, value, phi) of a fitted tree model; the phi of a row
    add up to its output minus the model's mean.  ``features`` in the model's order;
    a null is read as NaN, and goes right at every split.  With ``prefix``, the phi are
    columns ``prefix + feature`` beside those of ``df``, one row each."""
    features = list(features)
    _constant, paths = leaf_paths(model)
    x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features])
    if prefix is not None:
        wide = df.withColumn("_x", x)
        at, added = len(df.columns), [prefix + f for f in features]
        names = df.columns + added

        def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for first in range(0, b.num_rows, BLOCK):
                    part = b.slice(first, BLOCK)
                    phi = attribute_block(part.column(at).flatten().to_numpy().reshape(part.num_rows, len(features)), paths)
                    yield pa.RecordBatch.from_arrays([*part.columns[:at], *(pa.array(np.ascontiguousarray(c)) for c in phi.T)], names=names)

        return wide.mapInArrow(beside, StructType([*df.schema.fields, *(StructField(n, DoubleType()) for n in added)]))
    src = df.select(F.col(row_id), x.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, BLOCK):
                part = b.slice(first, BLOCK)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, len(features))
                at = pa.array(np.repeat(np.arange(len(x)), len(features)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(features * len(x)), pa.array(x.ravel()), pa.array(attribute_block(x, paths).ravel())],
                    names=[row_id, "feature", "value", "phi"])

    return src.mapInArrow(run, f"`{row_id}` {src.schema[0].dataType.simpleString()}, feature string, value double, phi double")
