"""Queries over the given tables, each next to its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

AREAS = ("corpus", "chat", "blocks", "chunks", "search", "scores", "tags", "models", "files")
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the twin that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return add


def load_all() -> None:
    for area in AREAS:
        import_module(f"{__name__}.{area}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a small table out to all cores.

    Only a table with fewer input splits than cores is touched, so its size is
    bounded by cores x split size; a large table keeps its scan partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for text-heavy work: needed columns only, spread over the cores."""
    return spread(table(spark, sf_dir, "documents").select(*columns))
