"""All registered queries and their DuckDB oracles, merged from the family modules."""

from __future__ import annotations

import importlib

_FAMILIES = [
    "tessera.plans.vector_queries",
    "tessera.plans.profile_queries",
    "tessera.plans.spending_queries",
    "tessera.plans.question_queries",
    "tessera.plans.receipt_queries",
    "tessera.plans.store_queries",
    "tessera.plans.stream_queries",
    "tessera.plans.join_queries",
    "tessera.plans.event_time_queries",
    "tessera.plans.sketch_queries",
]


def _load():
    queries, oracles = {}, {}
    for name in _FAMILIES:
        mod = importlib.import_module(name)
        queries.update(mod.QUERIES)
        oracles.update(getattr(mod, "ORACLES", {}))
    return queries, oracles


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
