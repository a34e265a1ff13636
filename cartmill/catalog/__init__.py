"""Queries on the driver tables, each next to the SQL that checks it."""

from __future__ import annotations

import importlib

MODULES = ("pipeline", "metrics", "helpers", "dates", "checks", "expectations", "profiles")


def load_catalog():
    """Import every catalogue module and return (queries, sql)."""
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
    from cartmill.catalog import registry

    return registry.QUERIES, registry.SQL
