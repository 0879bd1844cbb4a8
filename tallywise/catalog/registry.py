"""Named queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; ``sql`` is its DuckDB equivalent, if it has one."""
    def add(run: Run) -> Run:
        if name in REGISTERED:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTERED[name] = Query(run, sql)
        return run
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
