"""Named queries, each with the SQL that gives the same table where SQL can say it."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


class Registry(dict[str, Query]):
    def add(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        """Register the decorated function as query ``name``."""

        def register(build: Build) -> Build:
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(build, sql)
            return build

        return register


REGISTRY = Registry()
