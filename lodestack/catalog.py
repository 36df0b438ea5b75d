"""Registered queries of the library, gathered from the modules of lodestack.plans."""

from __future__ import annotations

import importlib
import pkgutil

from . import plans


def _modules():
    for found in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        yield importlib.import_module(f"{plans.__name__}.{found.name}")


def queries() -> dict:
    return {k: v for m in _modules() for k, v in getattr(m, "QUERIES", {}).items()}


def oracle_sql() -> dict:
    return {k: v for m in _modules() for k, v in getattr(m, "SQL", {}).items()}


def entry(spark, sf_dir: str):
    return queries()["i07_hybrid_search"](spark, sf_dir)
