"""Projections, patches and filters. Column pruning and predicate pushdown
are left to Catalyst: these are plain select/filter/join plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ordered_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """PRJ-1: the declared columns in declared order (missing ones fail analysis)."""
    return df.select(*columns)


def state_patch(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """PRJ-2: copy ``base`` and overwrite ``columns`` from ``patch`` where the patch has a
    value (left join on ``key`` + coalesce; one row per base row if the patch key is unique)."""
    p = patch.select(F.col(key).alias("_pk"), *[F.col(c).alias("_p_" + c) for c in columns])
    j = base.join(p, base[key] == p["_pk"], "left")
    out = []
    for c in base.columns:
        out.append(F.coalesce(F.col("_p_" + c), F.col(c)).alias(c) if c in columns else F.col(c))
    return j.select(*out)


def active_only(df: DataFrame, status_col: str = "status") -> DataFrame:
    """FLT-1."""
    return df.filter(F.col(status_col) == "ACTIVE")


def open_fulfilments(units: DataFrame) -> DataFrame:
    """FLT-2: drop CANCELLED / FAILED units; a missing status stays (it is not in the set)."""
    return units.filter(~F.coalesce(F.col("status").isin("CANCELLED", "FAILED"), F.lit(False)))


def events_of_type(events: DataFrame, types: list[str], col: str = "event_type") -> DataFrame:
    """FLT-4: an IN filter; on a Parquet scan it is pushed into the reader."""
    return events.filter(F.col(col).isin(*types))


def required_when(df: DataFrame, id_col: str, rules: list[tuple[str, str, list[str]]],
                  status_col: str = "status") -> DataFrame:
    """FLT-3: fields required for a status. ``rules`` = [(status, 'required'|'forbidden',
    columns)]. One row per (row, offending column): row-local, one pass, no shuffle."""
    checks = []
    for status, kind, cols in rules:
        for c in cols:
            bad = F.col(c).isNull() if kind == "required" else F.col(c).isNotNull()
            checks.append(F.when((F.col(status_col) == status) & bad,
                                 F.struct(F.lit(c).alias("column"), F.lit(kind).alias("rule"))))
    arr = F.filter(F.array(*checks), lambda s: s.isNotNull())
    return df.select(id_col, status_col, F.inline(arr))
