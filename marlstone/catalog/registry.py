"""A small registry of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marlstone.catalog.bindings import Tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None  # None where plain SQL cannot express the result

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


class Registry(dict):
    def add(self, name: str, sql: str | None = None):
        def register(build: Callable[[Tables], DataFrame]):
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(build, sql)
            return build

        return register
