"""Exact duplicates, the filter audit and whitening against plain Python."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.llm import exact_dedup, filter_audit, whitening

EXTRA = "hash int, body int, rest int, at int, row int, first int, clash int, group_size int, n int, mask int, lowest int, digest int"


@pytest.fixture(scope="module")
def clashing(spark, docs):
    """The corpus with columns named like the operators' own."""
    names = [f.split()[0] for f in EXTRA.split(", ")]
    return docs.select("doc_id", "text", "source", *[F.lit(7).alias(n) for n in names])


def survivor(members):
    return min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))


@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, lambda c: F.substring(F.md5(c), 1, 1)], ids=["whole", "colliding"])
def test_exact_groups(clashing, rows, hashed):
    """Also with a hash of 16 values, so that bytes decide."""
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    by_text = defaultdict(list)
    for r in rows:
        by_text[bare(r[1])].append(r)
    want = Counter((r[0], survivor(m)[0], len(m), hashlib.sha256(t.encode()).hexdigest()) for t, m in by_text.items() for r in m)
    got = exact_dedup.groups(clashing, hashed=hashed).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(by_text)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_ties_and_hot_groups(spark, none):
    """Repeated rows, ids all null, and one group of most rows: one row stays in each."""
    rows = [(5, "a b")] * 3 + [(None, "x  y")] * 4 + [(None, "xy")] + [(k, "hot text") for k in range(3000, 500, -1)] + [(9, "hottext")]
    got = exact_dedup.groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    assert sorted((len(m), m[0].group_size, sum(r.kept for r in m), m[0].keep_id if m[0].keep_id else -1) for m in by.values()) \
        == [(3, 3, 1, 5), (5, 5, 1, -1), (2501, 2501, 1, 501)]
    assert exact_dedup.groups(none).count() == 0


def test_survivors_keep_their_columns(clashing, rows):
    got = exact_dedup.survivors(clashing)
    assert got.columns == clashing.columns and got.where("hash <> 7 or at <> 7").count() == 0
    assert got.count() == len({re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows})


def test_exact_dedup_is_native(docs):
    plan = exact_dedup.groups(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def brute_audit(rows, labels):
    texts = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            texts[r[1] or ""].append(r[0])
    marks = defaultdict(set)
    for i, q, t in labels:
        marks[i] |= ({"good"} if q == 1 else set()) | ({"toxic"} if t == 1 else set())
    docs = []
    for r in rows:
        t = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {c for c, f in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            re.search(r"[#$%&*|]", t), any(r[0] is None or i < r[0] for i in texts[t]))) if f}
        docs.append((r[3] or "", bad, marks[r[0]] if r[0] is not None else set()))
    out = {}
    removed_by = Counter()
    for part in {d[0] for d in docs}:
        for o in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for k, c in enumerate(o):
                here = [d for d in left if c in d[1]]
                stay = [d for d in left if c not in d[1]]
                own = [d for d in docs if d[0] == part and d[1] == {c}]
                out[part, "".join(o), k + 1] = (len(stay), len(here), sum(c in d[1] for d in gone), len(own),
                                                sum("good" in d[2] for d in here), sum("toxic" in d[2] for d in here))
                removed_by[part, c] += len(here)
                gone, left = gone + here, stay
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark, clashing, rows, none):
    rng = random.Random(2)
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows[::2]] + [(3, 1, 0), (3, 0, 1), (None, 1, 1), (10 ** 9, 1, 1)]
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit(3)).withColumn("n", F.lit(3))
    got = filter_audit.audit_documents(clashing, lab).collect()
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in got} == brute_audit(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert filter_audit.audit_documents(none, lab).count() == 0


def test_audit_ids_shared_by_rows(spark):
    """Null ids come last, rows with the smallest id do not fail for each other."""
    rows = [(1, "same", None, "p"), (1, "same", None, "q"), (2, "same", None, "p"), (None, "same", None, "p"), (None, "free", None, "p"),
            (None, "free", None, None), (4, None, None, "q"), (3, "", None, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = filter_audit.audit_documents(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    cols = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in got} == brute_audit(rows, [])


def test_packed_fields_do_not_carry():
    """Counts near 2**62 in every mask still unpack exactly."""
    table, n = filter_audit.packed(), 1 << 57
    got = filter_audit.unpack(sum(x * (n + i) for i, x in enumerate(table)))
    one = [filter_audit.unpack(x) for x in table]
    assert (got == sum(f.astype(object) * (n + i) for i, f in enumerate(one))).all()
    assert len(filter_audit.packed("ABC")) == 8 and filter_audit.unpack(filter_audit.packed("ABC")[0], "ABC").shape == (4, 6, 3)


def vectors(n=400, d=12, seed=4):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.05, 0.4, d) @ rng.normal(size=(d, d))).astype(np.float32).tolist()


def test_whitening(spark):
    good = vectors()
    bad = [None, [], [float("nan")] + good[0][1:], good[1][:-1] + [float("inf")], [None] + good[2][1:]]
    rows = [(i, v, 1, 2.0, "x") for i, v in enumerate(good + good[:30] + bad)] + [(None, good[7], None, None, None), (3, good[3], 1, 1.0, "y")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n int, deviation double, whitened string").repartition(5)
    got = whitening.whiten(df).collect()
    keep = [(r[0], r[1]) for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.floor(1024 * np.array([v for _i, v in keep], np.float64)).astype(np.int64) + 100000
    n, s = len(x), x.sum(0)
    centred = x - s / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1][:8], parts[:, ::-1][:, :8]
    white = centred @ parts / np.sqrt(values)
    want = Counter((i, j + 1, n, int(((n * x[k] - s) ** 2).sum()), round(abs(white[k, j]), 9)) for k, (i, _v) in enumerate(keep) for j in range(8))
    assert Counter((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9)) for r in got) == want
    assert max(abs(r.explained / (values[r.component - 1] / np.trace(centred.T @ centred / n)) - 1) for r in got) < 1e-9
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    sign = {c: {np.sign(r.whitened) * np.sign(white[[i for i, _v in keep].index(r.vec_id), c - 1]) for r in got if r.component == c and r.vec_id is not None}
            for c in range(1, 9)}
    assert all(len(v) == 1 for v in sign.values())


def test_whitening_small_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert whitening.whiten(make([])).count() == 0 and whitening.whiten(make([(1, None)])).count() == 0
    assert whitening.whiten(make([(1, [0.5, 0.1])])).count() == 0
    assert whitening.whiten(make([(k, [0.5, 0.1]) for k in range(5)])).count() == 0
    line = whitening.whiten(make([(k, [0.1 * k, 0.2 * k, 0.3]) for k in range(6)])).collect()
    assert {r.component for r in line} <= {1, 2} and line[0].explained > 0.99
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(make([(1, [0.5]), (2, [0.5, 1.0])]))


def test_wide_deviation_is_exact(spark):
    """Values past 2**63 come out exact, as a decimal."""
    vs = [(k, [float(2 ** 20 * (k % 7)), float(2 ** 18 * (k % 5)), float(k)]) for k in range(300)]
    out = whitening.whiten(spark.createDataFrame(vs, "vec_id bigint, embedding array<double>"))
    assert dict(out.dtypes)["deviation"] == "decimal(38,0)"
    x = [[int(c * 1024) + 100000 for c in v] for _k, v in vs]
    s = [sum(c) for c in zip(*x)]
    want = {k: sum((300 * c - t) ** 2 for c, t in zip(v, s)) for k, v in enumerate(x)}
    got = {r.vec_id: int(r.deviation) for r in out.collect()}
    assert got == want and max(want.values()) >= 1 << 63


def test_jacobi_against_plain_eigenvalues():
    rng = np.random.default_rng(1)
    for d, n in ((1, 3), (2, 9), (7, 5), (40, 90)):
        x = rng.normal(size=(n, d)) * np.logspace(0, 4, d)
        v = (x - x.mean(0)).T @ (x - x.mean(0))
        values, parts = whitening.eigen(v)
        plain = np.linalg.eigvalsh(v)[::-1][:len(values)]
        big = plain > plain[0] * 1e-9
        assert np.allclose(values[big], plain[big], rtol=1e-6) and np.allclose(parts.T @ parts, np.eye(len(values)), atol=1e-12)
        assert np.allclose(v @ parts[:, :1], values[0] * parts[:, :1], atol=1e-9 * values[0])
        factor, order = whitening.pivoted_cholesky(v)
        assert np.allclose((factor @ factor.T), v[order][:, order], atol=1e-9 * values[0])
        assert np.allclose(factor, np.tril(factor)) and (np.diff(np.diag(factor)) <= 1e-9 * factor[0, 0]).all()
