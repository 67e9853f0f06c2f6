"""The driver contract: entry runs, every oracle has a query, names are unique."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    m = _entry()
    df = m.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["tenure_group", "is_auto_payment", "has_any_addon", "n", "share"]
    assert abs(sum(r["share"] for r in rows) - 1.0) < 1e-5


def test_oracles_have_queries():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50
