"""Registry of checked queries: name -> (Spark builder, DuckDB oracle SQL).

A query builder takes ``(spark, sf_dir)`` and returns a DataFrame; the oracle
is an ANSI-SQL string over the driver's tables.  Builders live next to the
operators they exercise (``tickwise.plans.q_*``) and register here.
"""
from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Import for side effects: each module registers its queries.
    from tickwise.plans import q_sources, q_timeseries, q_projections, q_metrics, q_checks, q_rules, q_ml, q_forecast, q_scalars, q_models, q_registry  # noqa: F401
