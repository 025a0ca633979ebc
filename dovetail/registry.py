"""Query registry: key -> Spark builder + oracle SQL (DuckDB dialect).

Builders take ``(spark, sf_dir)`` and return a DataFrame over the driver tables
(or over data Spark derives from them). ``sql`` is an independent statement over
the same parquet tables registered as views; ``None`` marks keys whose semantics
are not expressible in SQL (checked rows-only).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    build: Builder
    sql: str | None
    family: str


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None, family: str = ""):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, family or fn.__module__.rsplit(".", 1)[-1])
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every plan module (each registers its keys) and return the registry."""
    import importlib
    import pkgutil

    import dovetail.plans as plans
    for m in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        importlib.import_module(f"dovetail.plans.{m.name}")
    return REGISTRY
