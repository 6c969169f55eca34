"""Validation by ordered rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failing_rule(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition is true; NULL if none is. A NULL condition is not a hit."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules])


def split_by_tag(df: DataFrame, tag: str) -> tuple[DataFrame, DataFrame]:
    """(rows without a tag, rows with one)."""
    return df.filter(F.col(tag).isNull()), df.filter(F.col(tag).isNotNull())


def full_match(text: Column, pattern: str) -> Column:
    """The whole text matches; a line end before the end does not count as the end."""
    return text.rlike(rf"\A(?:{pattern})\z")
