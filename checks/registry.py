"""Where queries and their twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.duck import twin
from checks.views import Views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def check(name: str, sql: str | None = None, **renamed: str) -> Callable[[Callable[[Views], DataFrame]], None]:
    """Register a query over the derived tables, with its SQL twin unless rows are all that can be checked."""

    def register(build: Callable[[Views], DataFrame]) -> None:
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            TWINS[name] = twin(sql, **renamed)

    return register
