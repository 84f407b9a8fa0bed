"""Collects each query with its oracle under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# The same queries as functions of their input views.
ON_VIEWS: dict[str, Callable[[Views], DataFrame]] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(views) -> DataFrame``; the oracle may mention any view by name."""

    def add(fn: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))

        run.__name__ = name
        ON_VIEWS[name] = fn
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(oracle)
        return fn

    return add
