"""Every operator and job as a query over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module
from types import ModuleType

MODULES = ["scalars", "relational", "tables", "lake"]


def load() -> ModuleType:
    """Import all query modules and return the catalog they registered in."""
    for name in MODULES:
        import_module(f"tapedeck.registry.{name}")
    return import_module("tapedeck.registry.catalog")
