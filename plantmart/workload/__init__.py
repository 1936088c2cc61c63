"""The registered queries: every operator on the driver's tables, each with an SQL answer."""

from __future__ import annotations

from importlib import import_module

from .registry import QUERIES, SQL

for _name in ("shaping", "filters", "joining", "aggregating", "windows", "reshaping", "scalars", "stored", "plant", "pricing"):
    import_module(f"{__name__}.{_name}")

__all__ = ["QUERIES", "SQL"]
