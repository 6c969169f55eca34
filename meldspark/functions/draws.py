"""Seeded draws: a pure function of seed, purpose and key, so equal on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 60


def draw(seed: int, purpose: str, key: Column) -> Column:
    """Uniform whole number in [0, 2^60): the first 15 hex digits of md5("seed:purpose:key")."""
    text = F.concat(F.lit(f"{seed}:{purpose}:"), key.cast("string"))
    return F.conv(F.left(F.md5(text), F.lit(15)), 16, 10).cast("bigint")


def draw_below(seed: int, purpose: str, key: Column, bound: Column | int) -> Column:
    limit = bound.cast("bigint") if isinstance(bound, Column) else F.lit(bound).cast("bigint")
    return draw(seed, purpose, key) % limit


def draw_between(seed: int, purpose: str, key: Column, low: int, high: int) -> Column:
    """Uniform whole number, both ends included."""
    return draw_below(seed, purpose, key, high - low + 1) + low


def happens(seed: int, purpose: str, key: Column, share: float) -> Column:
    """True for the given share of keys."""
    return draw(seed, purpose, key) < F.lit(int(round(share * 2**DRAW_BITS))).cast("bigint")


def pick(seed: int, purpose: str, key: Column, values: Column) -> Column:
    """One element of an array column."""
    return F.element_at(values, (draw_below(seed, purpose, key, F.size(values)) + 1).cast("int"))


def pattern_text(seed: int, purpose: str, key: Column, pattern: Column) -> Column:
    """Fills a pattern: # becomes a digit, @ a capital letter, other characters stay."""

    def fill(symbol: Column, i: Column) -> Column:
        value = draw(seed, purpose, F.concat(key.cast("string"), F.lit(":"), i.cast("string")))
        return (
            F.when(symbol == "#", (value % 10).cast("string"))
            .when(symbol == "@", F.char(F.lit(65) + value % 26))
            .otherwise(symbol)
        )

    return F.array_join(F.transform(F.split(pattern, ""), fill), "")
