"""Registered queries: every operator run over whole supplied tables, with its SQL twin."""

from __future__ import annotations


def load() -> dict:
    """All registered queries: name to ``Query``."""
    from . import derived, facts, lookups, published, rules, schema, scalars  # noqa: F401
    from .base import REGISTRY

    return REGISTRY
