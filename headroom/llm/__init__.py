"""Training-data operators over the text tables; nothing else in the library imports this package."""

from __future__ import annotations

import importlib
import pkgutil


def _modules():
    for info in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        module = importlib.import_module(f"{__name__}.{info.name}")
        if hasattr(module, "QUERIES"):
            yield module


def queries():
    """Query name -> function of (session, table folder)."""
    return {name: query for module in _modules() for name, query in module.QUERIES.items()}


def oracle_sql():
    """Query name -> the same rows as DuckDB SQL, where SQL can express them."""
    return {name: sql for module in _modules() for name, sql in module.ORACLE.items()}
