"""All registered queries, merged from the per-area query modules."""

from __future__ import annotations

import importlib

MODULES = ["etl", "star", "bi", "quality", "dups", "stats", "evaluation", "scoring", "text", "ml", "mining", "io"]


def _registries():
    for m in MODULES:
        yield importlib.import_module(f"{__package__}.{m}").R


def queries() -> dict:
    out = {}
    for r in _registries():
        out.update(r.builders)
    return out


def oracle_sql() -> dict:
    out = {}
    for r in _registries():
        out.update(r.sql)
    return out
