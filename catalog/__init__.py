"""Queries over the driver tables, each with its SQL counterpart where one exists."""

from __future__ import annotations


def all_queries() -> dict:
    """Name -> (function of session and folder, SQL text or None)."""
    from catalog import cleaning, encoding, engagement, models, scoring, text

    found: dict = {}
    for module in (engagement, cleaning, encoding, text, scoring, models):
        found.update(module.QUERIES)
    return found
