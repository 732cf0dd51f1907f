"""Checked queries: one Spark DataFrame query per operator, each with the
DuckDB SQL text that must give the same rows over the same fixture views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    # Imported for their registrations.
    from aggrex.registry import (  # noqa: F401
        align_q, completion_q, incremental_q, loop_q, normalise_q, pages_q, period_q, plan_q, push_q, report_q)
