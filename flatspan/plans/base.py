"""Registration of the queries and the tables they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL it is checked against where SQL can say it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"two queries named {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_kept: dict[tuple[str, str, str], DataFrame] = {}


def kept(spark: SparkSession, sf: str, name: str, build: Query) -> DataFrame:
    """A stage several queries start from, persisted once per application and input folder.

    It spills to executor disk, and what a lost executor held is computed again from the input.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _kept:
        _kept[key] = build(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    return _kept[key]


def forget() -> None:
    """Let go of all kept stages."""
    for df in _kept.values():
        df.unpersist()
    _kept.clear()
