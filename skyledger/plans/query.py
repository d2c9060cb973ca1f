"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A DataFrame plan over the tables of a folder, and the same in DuckDB SQL where SQL can express it."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(into: list[Query], sql: str | None = None):
    """Registers a plan that takes ``Tables`` under its own name."""

    def keep(plan: Callable[[Tables], DataFrame]):
        into.append(Query(plan.__name__, lambda spark, folder: plan(Tables(spark, folder)), sql))
        return plan

    return keep
