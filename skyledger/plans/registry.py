"""All registered queries. Each module of this package lists its own pairs of DataFrame plan and SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("history", "columns", "relations", "spatial", "texts", "feeds", "areas", "regulations", "editions")


def _all():
    for name in MODULES:
        yield from import_module(f"skyledger.plans.{name}").QUERIES


def queries() -> dict:
    return {q.name: q.run for q in _all()}


def oracle_sql() -> dict[str, str]:
    return {q.name: q.sql for q in _all() if q.sql}
