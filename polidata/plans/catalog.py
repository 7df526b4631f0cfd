"""Registry of catalogue queries: name -> (spark, sf_dir) -> DataFrame, plus
the DuckDB oracle SQL for each one that SQL can express."""

from __future__ import annotations

import importlib
from functools import wraps

from polidata.session import ship_package

_MODULES = ["emissions", "q_shape", "q_window", "q_join", "q_text", "q_sources", "q_geo", "q_match", "q_candidates", "q_quality", "q_pipelines"]


def _load():
    queries, oracle = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"polidata.plans.{m}")
        queries.update(getattr(mod, "QUERIES", {}))
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def _shipped(query):
    """The query, after the package's code was sent to the executors (some queries run Python functions there)."""
    @wraps(query)
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def queries():
    return {name: _shipped(q) for name, q in _load()[0].items()}


def oracle_sql():
    return _load()[1]
