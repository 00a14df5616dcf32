"""All queries on the driver tables."""

from __future__ import annotations

from bindings import ordered, pages, reports, stores, streams, texts


def all_queries():
    found = {}
    for module in (reports, texts, ordered, streams, pages, stores):
        found.update(module.QUERIES)
    return found
