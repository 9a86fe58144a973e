"""The registered queries, each with the SQL that has to give the same rows."""

from __future__ import annotations

from importlib import import_module

from .registry import REGISTERED

for _area in ("text", "products", "merging", "model", "checks", "traces", "documents",
              "reports"):
    import_module(f"{__name__}.{_area}")

__all__ = ["REGISTERED"]
