"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def distinct_list(label: str, sep: str = ",") -> Column:
    """The distinct values of a low-cardinality column, sorted, as one text."""
    return F.array_join(F.array_sort(F.collect_set(label)), sep)


def merge_by_trust(
    rows: DataFrame, key: str, trust: Sequence[str], keep: Sequence[str], label: str, label_list: str
) -> DataFrame:
    """The most trusted row of every key, taken whole, with the list of all labels seen for the key.

    One aggregate, one shuffle: each task first reduces its own rows to one candidate per key, so a key with
    very many copies costs no more than any other.
    """
    winner = F.min_by(F.struct(*keep), F.struct(*trust))
    return (
        rows.groupBy(key)
        .agg(winner.alias("_winner"), distinct_list(label).alias(label_list))
        .select(key, "_winner.*", label_list)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], rank: str = "_rank") -> DataFrame:
    """First row of every key in the given order. Spark cuts each task to one row per key before the shuffle."""
    return (
        df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
        .filter(F.col(rank) == 1)
        .drop(rank)
    )
