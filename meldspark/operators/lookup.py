"""Dictionary lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldspark.session import broadcast_if_small


def lookup_left(
    df: DataFrame, text: Column, dictionary: DataFrame, key: str, value: str, name: str, rows: int | None = None
) -> DataFrame:
    """Adds ``name``: the dictionary value for ``text``, NULL where there is none.

    The dictionary is broadcast only if its size, given or counted, is small; its keys must be unique.
    """
    entries = broadcast_if_small(dictionary.select(F.col(key).alias("_key"), F.col(value).alias(name)), rows)
    return df.join(entries, text == F.col("_key"), "left").drop("_key")
