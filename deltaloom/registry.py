"""Every registered query by name, with its SQL counterpart where there is one."""

from __future__ import annotations

from .plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
