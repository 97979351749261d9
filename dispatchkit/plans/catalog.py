"""All registered queries, imported in SURVEY section order."""

from __future__ import annotations

import importlib

from .registry import ORACLE, QUERIES

_MODULES = ["q_aggs", "q_joins", "q_windows", "q_lifecycle", "q_scalars", "q_quality", "q_sources", "q_stream"]
_loaded = False


def _load() -> None:
    global _loaded
    if not _loaded:
        for m in _MODULES:
            importlib.import_module(f"{__package__}.{m}")
        _loaded = True


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
