"""All registered fixture queries and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

_MODULES = [
    "scorewell.plans.prep_queries",
    "scorewell.plans.metric_queries",
    "scorewell.plans.drift_queries",
    "scorewell.plans.monitor_queries",
    "scorewell.plans.model_queries",
    "scorewell.plans.scoring_queries",
    "scorewell.plans.stream_queries",
    "scorewell.plans.training_queries",
]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(importlib.import_module(m).QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(getattr(importlib.import_module(m), "ORACLE", {}))
    return out
