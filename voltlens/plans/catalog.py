"""Query catalog: one entry per operator of the blueprint inventory.

Every entry is ``name -> (spark_fn, oracle_sql)``; ``spark_fn(spark, sf_dir)``
returns a DataFrame over the analogue tables, ``oracle_sql`` is the DuckDB
statement computing the same rows (None where no SQL twin exists, e.g.
trained models). Names follow ``<inventory id>_<slug>``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        _REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # importing the modules fills the registry
    from voltlens.plans import q_core, q_clean, q_funcs, q_model, q_boost, q_eval, q_io, q_joins  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}
