"""Registered queries, by stage."""

from __future__ import annotations

from importlib import import_module

from subjectloom.plans import catalog

_STAGES = ("cleaning", "labelling", "storage", "scoring", "evaluation", "modelling")


def _load() -> None:
    for stage in _STAGES:
        import_module(f"subjectloom.plans.{stage}")


def all_queries() -> dict[str, catalog.Query]:
    _load()
    return dict(catalog.QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(catalog.SQL)
