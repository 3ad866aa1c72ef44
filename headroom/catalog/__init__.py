"""Registered queries over the driver's tables, each with SQL giving the same rows."""

from __future__ import annotations

import functools
import importlib
import pkgutil


def _modules():
    for info in sorted(pkgutil.iter_modules(__path__), key=lambda m: m.name):
        if info.name != "views":
            yield importlib.import_module(f"{__name__}.{info.name}")


def _in_utc(query):
    """The views read naive UTC times, so the session zone has to be UTC."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries():
    found = {}
    for module in _modules():
        found.update({name: _in_utc(query) for name, query in module.QUERIES.items()})
    return found


def oracle_sql():
    found = {}
    for module in _modules():
        found.update(module.ORACLE)
    return found
