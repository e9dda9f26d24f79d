"""Registration of check queries: a Spark callable and, where there is one, the SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelens.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)  # the registered query; ``fn`` itself may get more names

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
