"""Numeric text parsing (SC-4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_float(c) -> Column:
    """SC-4: text -> double; NULL (and a violation upstream) when not a number.
    A plain cast would raise under ANSI mode."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")
