"""Registered queries over the driver's tables."""

from __future__ import annotations

import importlib

MODULES = ("model_queries", "column_queries", "report_queries", "flow_queries")


def all_entries():
    from registry.base import ENTRIES
    for module in MODULES:
        importlib.import_module(f"registry.{module}")
    return dict(ENTRIES)
