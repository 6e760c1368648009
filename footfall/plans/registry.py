"""Named queries with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    run: Runner
    oracle: str | None


CATALOG: dict[str, Query] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Runner], Runner]:
    """Register ``fn(spark, sf_dir)`` under ``key``; no ``oracle`` = rows only."""

    def add(fn: Runner) -> Runner:
        if key in CATALOG:
            raise ValueError(f"query {key} is registered twice")
        CATALOG[key] = Query(key, fn, oracle)
        return fn

    return add
