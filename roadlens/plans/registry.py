"""Registered checks: each name maps to a Spark query and (mostly) an SQL oracle.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables; the oracle is DuckDB SQL over the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, oracle_body: str | None = None, raw: bool = False):
    """Register ``fn`` under ``name`` with its oracle body (adapter CTEs prepended)."""

    def deco(fn):
        QUERIES[name] = fn
        if oracle_body is not None:
            ORACLE[name] = oracle_body.strip() if raw else O.sql(oracle_body)
        return fn

    return deco


def _load_all() -> None:
    # importing the modules registers their checks
    from . import checks_core, checks_history, checks_ingest, checks_joins, checks_requests  # noqa: F401


_load_all()
