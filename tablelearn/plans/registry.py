"""Registry of named queries and their SQL oracles.

Every query reads the driver tables (or data Spark derives from them) in
full; its oracle is DuckDB SQL over the same tables, written from the
definition rather than from the Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle (None: rows-only)."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every workload module so its queries register themselves."""
    import importlib
    import pkgutil

    from . import workloads

    for mod in pkgutil.iter_modules(workloads.__path__):
        importlib.import_module(f"{workloads.__name__}.{mod.name}")
