"""Registered queries: every operator on the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meldspark.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its own name."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """For heavy per-row work: only the needed columns, spread over all cores if the file has too few splits."""
    df = table(spark, sf_dir, name)
    return spread(df.select(*columns) if columns else df)
