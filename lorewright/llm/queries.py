"""Queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import importlib
import importlib.util

_MODULES = ("layout", "dedup", "scans", "match", "registry", "pairs", "spam")

QUERIES: dict = {}
SQL: dict = {}
for _m in _MODULES:
    _name = f"lorewright.llm.{_m}_queries"
    if importlib.util.find_spec(_name) is not None:
        _mod = importlib.import_module(_name)
        QUERIES |= _mod.QUERIES
        SQL |= _mod.SQL
