"""Registered queries."""

from __future__ import annotations

import importlib

from brightwater.plans.registry import ORACLES, QUERIES, Query

MODULES = ["ingest", "features", "prep", "models", "text", "store", "monitor", "stream"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"brightwater.plans.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
