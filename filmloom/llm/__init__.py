"""Operators for training-data pipelines; nothing else in the library imports them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_MODULES = ["truncation", "sampling", "components", "ranking", "repetition", "capping", "cutoffs", "packing", "leakage", "readability"]


def queries() -> dict[str, Callable]:
    """All pN_ queries by name."""
    out: dict[str, Callable] = {}
    for m in _MODULES:
        out |= import_module(f"{__name__}.{m}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    """Equivalent SQL of those queries that plain SQL can express."""
    from filmloom.llm.oracles import SQL

    return dict(SQL)
