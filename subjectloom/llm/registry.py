"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from importlib import import_module

from subjectloom.plans.catalog import Query

_MODULES = (
    "bpe", "exact_dedup", "line_dedup", "pivot_search", "secrets", "url_filter", "mixing",
    "language_id", "jaccard_join", "toxicity", "nra_search", "ngram_model", "vector_codes",
)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in _MODULES:
        found.update(import_module(f"subjectloom.llm.{name}").QUERIES)
    return found


def sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in _MODULES:
        found.update(getattr(import_module(f"subjectloom.llm.{name}"), "SQL", {}))
    return found
