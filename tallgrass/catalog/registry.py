"""Registered queries and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallgrass.session import configure, load_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


class Tables:
    """The tables of one data folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # called only for names not set yet: a table is opened once per query
        if name.startswith("_"):
            raise AttributeError(name)
        table = load_table(self.spark, self.folder, name)
        setattr(self, name, table)
        return table


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``fn(tables) -> DataFrame`` under ``name``, with its SQL twin if there is one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return fn

    return register
