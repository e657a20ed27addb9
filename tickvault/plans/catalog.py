"""The full query catalogue: importing the ``q_*`` modules registers them."""

from __future__ import annotations

import importlib

from .registry import REGISTRY, oracle_text, spark_fn

MODULES = ["q_bars", "q_checks", "q_symbols", "q_windows", "q_rolls", "q_calendar", "q_coverage", "q_curves", "q_io", "q_streams",
           "q_jobs"]

for _m in MODULES:
    importlib.import_module(f"{__package__}.{_m}")


def queries():
    return {name: spark_fn(name) for name in REGISTRY}


def oracle_sql():
    out = {}
    for name in REGISTRY:
        sql = oracle_text(name)
        if sql is not None:
            out[name] = sql
    return out
