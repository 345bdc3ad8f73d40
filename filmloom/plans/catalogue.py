"""Queries over the test tables, by name, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_MODULES = ["scores", "records", "media", "texts"]


def _gather(name: str) -> dict:
    out: dict = {}
    for m in _MODULES:
        out |= getattr(import_module(f"filmloom.plans.{m}"), name)
    return out


def queries() -> dict[str, Callable]:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("SQL")
