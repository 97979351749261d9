"""Query registry: name -> (spark, sf_dir) -> DataFrame, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_tables import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SECTION: dict[str, str] = {}


def query(name: str, oracle: str | None = None, section: str = ""):
    """Register a query. ``oracle`` is DuckDB SQL over the raw views; the derived
    ``qc_*`` tables it mentions are prefixed as CTEs."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SECTION[name] = section
        if oracle is not None:
            ORACLE[name] = with_tables(oracle)
        return fn
    return deco
