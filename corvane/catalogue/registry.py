"""The table of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.catalogue.views import SQL_VIEWS, Views
from corvane.session import prepare

Build = Callable[[Views], DataFrame]
_builds: dict[str, Build] = {}
_sql: dict[str, str] = {}


def query(key: str, sql: str | None = None, views: str = "") -> Callable[[Build], Build]:
    """Register a query under ``key``; ``sql`` may name the derived ``views``."""

    def register(build: Build) -> Build:
        if key in _builds:
            raise ValueError(f"{key} is registered twice")
        _builds[key] = build
        if sql is not None:
            named = [f"{name} AS ({SQL_VIEWS[name].strip()})" for name in views.split()]
            _sql[key] = (f"WITH {', '.join(named)} " if named else "") + " ".join(sql.split())
        return build

    return register


def _runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(Views(prepare(spark), folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _runner(build) for key, build in _builds.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
