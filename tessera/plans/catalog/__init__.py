"""Registered queries: one Spark callable and (where SQL can say it) one
DuckDB oracle per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole test tables.  Oracles recompute the same result from the raw table
views; computed columns carry the same alias on both sides and floating
values are rounded the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from tessera.plans.oracle_frames import with_frames

QueryFn = Callable
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None, frames: tuple[str, ...] = ()):
    """Decorator: register ``fn`` under ``name`` with its oracle SQL body."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, with_frames(sql, *frames) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    from tessera.plans.catalog import (  # noqa: F401
        sqlgen, features, learned, metrics, models, monitor, profile, quality, tuning, sources)
    return REGISTRY
