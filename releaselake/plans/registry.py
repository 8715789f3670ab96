"""Queries over the adapter views, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.adapter import view, with_views

View = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a function of the views. ``sql`` may be None where SQL cannot express the query."""

    def add(f: Callable[[View], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: view(spark, sf_dir, name))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return add
