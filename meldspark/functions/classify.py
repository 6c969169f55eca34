"""Classes by ordered thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The limits and names of the two class systems.
INCOME_BRACKETS = ((20_000, "low"), (100_000, "mid"))
INCOME_TOP = "high"
WEALTH_CLASSES = ((20, "rich"), (5, "middle"))
WEALTH_REST = "poor"


def bracket_below(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Name of the first limit the value is below. A NULL value is below none and falls to ``rest``."""
    chain = F
    for limit, name in limits:
        chain = chain.when(value < limit, name)
    return chain.otherwise(rest)


def class_at_least(value: Column, floors: Sequence[tuple[float, str]], rest: str) -> Column:
    """Name of the first floor the value reaches."""
    chain = F
    for floor, name in floors:
        chain = chain.when(value >= floor, name)
    return chain.otherwise(rest)


def income_bracket(income: Column) -> Column:
    return bracket_below(income, INCOME_BRACKETS, INCOME_TOP)


def ratio_class(
    amount: Column,
    heads: Column,
    rounded: bool = True,
    floors: Sequence[tuple[float, str]] = WEALTH_CLASSES,
    rest: str = WEALTH_REST,
) -> Column:
    """Class of amount per head, by the ratio rounded to one decimal or by the exact decimal ratio."""
    if rounded:
        return class_at_least(F.round(amount / heads, 1), floors, rest)
    return class_at_least(amount.cast("decimal(18,2)") / heads.cast("decimal(18,2)"), floors, rest)
