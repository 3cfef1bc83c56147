"""Queries that run the operators over the test tables, each with the SQL that should agree."""
from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from boxloom import scale
from boxloom.operators.overlap import PAIR_LIMIT
from boxloom.plans import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables and the annotation-shaped views over them, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def crowded(self) -> bool:
        """Whether some image holds many boxes; counted once a query."""
        key = fixtures.KEY["detections"]
        return scale.has_oversized(fixtures.table(self.spark, self.folder, fixtures.SOURCE["detections"]), [key], PAIR_LIMIT)

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.KEY:
            return fixtures.view(self.spark, self.folder, name, by_image=not self.crowded)
        if name in fixtures.VIEWS:
            return fixtures.view(self.spark, self.folder, name)
        if name in fixtures.TABLES:
            return fixtures.table(self.spark, self.folder, name)
        raise AttributeError(name)


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame`` under a name; ``sql`` may use the named views."""

    def add(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = fixtures.with_views(views, sql)
        return fn

    return add
