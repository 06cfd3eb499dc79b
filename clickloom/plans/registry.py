"""Every operator as a named query on the given tables, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.plans.lake import Lake

Build = Callable[[Lake], DataFrame]
_BUILD: dict[str, Build] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        _BUILD[name] = build
        if sql:
            _SQL[name] = sql
        return build
    return register


def _load() -> None:
    from clickloom.plans import queries_history, queries_landing, queries_models, queries_profile, queries_ranking, queries_stats  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Lake.at(spark, folder))

    return {name: bind(build) for name, build in sorted(_BUILD.items())}


def all_sql() -> dict[str, str]:
    _load()
    return dict(sorted(_SQL.items()))
