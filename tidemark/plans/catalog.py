"""Loads every section and exposes the registered queries."""

from __future__ import annotations

import importlib
import pkgutil

from tidemark import plans
from tidemark.plans.registry import CHECK_SQL, QUERIES


def _load() -> None:
    for module in pkgutil.iter_modules(plans.__path__):
        if module.name.startswith("section_"):
            importlib.import_module(f"{plans.__name__}.{module.name}")


def queries():
    _load()
    return dict(QUERIES)


def check_sql():
    _load()
    return dict(CHECK_SQL)
