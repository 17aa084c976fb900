"""Named queries with their SQL counterparts.

Each module adds entries through ``query(name, sql)``; ``QUERIES`` and ``SQL`` are what the driver reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.catalog.sqltext import with_frames
from tierflow.plans.domain import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``fn(Tables) -> DataFrame`` under ``name``; ``sql`` may use the domain frames by name."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_frames(sql)
        return fn

    return register


def load_all() -> None:
    from tierflow.catalog import (  # noqa: F401
        aggregates,
        features,
        incremental,
        ingest,
        joins,
        metrics,
        parsing,
        quality,
        saved,
        telemetry,
        versioned,
        windows,
    )
