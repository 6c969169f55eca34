"""Uniform samples of fixed size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldspark.functions.draws import draw

FAN_IN = 256  # groups of tasks whose rows are reduced once more before the last step


def _first_of_task(df: DataFrame, order: list[str | Column], size: int) -> DataFrame:
    """The first ``size`` rows of every task: a local sort, no exchange."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.sortWithinPartitions(*order).filter(place < size)


def fixed_sample(df: DataFrame, key: str, size: int, seed: int, purpose: str = "sample") -> DataFrame:
    """The ``size`` rows with the smallest seeded draws: a uniform sample that is equal on every run.

    One pass over the rows. Every task keeps its own ``size`` smallest, groups of tasks reduce them to ``size`` again, and only
    those meet in one place, so nothing has to be counted before and no place gets rows from every task. Rows
    without a key have no draw and are never sampled, whatever the table's size.
    """
    order: list[str | Column] = ["_draw", key]
    drawn = df.filter(F.col(key).isNotNull()).withColumn("_draw", draw(seed, purpose, F.col(key)))
    nearest = _first_of_task(drawn, order, size).withColumn("_group", F.spark_partition_id() % FAN_IN)
    nearest = _first_of_task(nearest.repartition("_group"), order, size)
    return nearest.orderBy(*order).limit(size).drop("_draw", "_group")
