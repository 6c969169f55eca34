"""Key, reference, range and length checks. Each returns only the offending keys with their row counts.

``column_findings`` takes all checks of a table that need nothing but its own columns in one scan; keys and references
need a shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ROWS_PER_TASK = 500_000  # about 350 bytes each while they are counted


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Rows with a NULL in the key never collide.

    Nearly all keys differ, so counting before the shuffle saves nothing, and shuffled partitions merged by their bytes hold
    millions of keys, more of them the larger the table. The rows are counted first (a column store knows their number) and
    dealt out so that a task has no more than about ``ROWS_PER_TASK`` of them, however many there are. Rows of one key are
    one entry there.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.select(*keys).filter(present).repartition(tasks, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows) for every column that holds NULLs, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "rows").filter(F.col("rows") > 0)


def orphans(child: DataFrame, reference: str, parent: DataFrame, key: str) -> DataFrame:
    """Child references without a parent. References are counted before the join, so a frequent one is one row.

    An outer join with a NULL filter, because the optimizer moves an anti-join below the aggregate.
    """
    used = child.filter(F.col(reference).isNotNull()).groupBy(reference).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(key).alias("_parent"))
    return (
        used.join(parents, F.col(reference) == F.col("_parent"), "left")
        .filter(F.col("_parent").isNull())
        .select(reference, "rows")
    )


def out_of_range(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Values that do not fit decimal(precision, scale)."""
    fits = F.col(column).try_cast(f"decimal({precision},{scale})").isNotNull()
    return df.filter(F.col(column).isNotNull() & ~fits).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def too_long(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Texts longer than ``limit`` characters."""
    return df.filter(F.length(column) > limit).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


class ColumnCheck(NamedTuple):
    """What is wrong with a row, and the key under which the finding is counted."""

    broken: Column
    key: Column


def required(*columns: str) -> list[ColumnCheck]:
    """NULLs, counted by column name."""
    return [ColumnCheck(F.col(c).isNull(), F.lit(c)) for c in columns]


def in_range(column: str, precision: int, scale: int) -> list[ColumnCheck]:
    """Values that do not fit decimal(precision, scale), counted by value."""
    fits = F.col(column).try_cast(f"decimal({precision},{scale})").isNotNull()
    return [ColumnCheck(F.col(column).isNotNull() & ~fits, F.col(column).cast("string"))]


def not_longer(column: str, limit: int) -> list[ColumnCheck]:
    """Texts longer than ``limit`` characters, counted by text."""
    return [ColumnCheck(F.coalesce(F.length(column) > limit, F.lit(False)), F.col(column).cast("string"))]


def column_findings(df: DataFrame, checks: Mapping[str, Sequence[ColumnCheck]]) -> DataFrame:
    """(check, key, rows) of all ``checks`` (name -> from ``required``, ``in_range``, ``not_longer``), from one scan.

    Sound rows are filtered out first, so that only findings are built and shuffled, and those are counted before.
    """
    flat = [(name, check) for name, several in checks.items() for check in several]
    finding = [F.when(c.broken, F.struct(F.lit(name).alias("check"), c.key.alias("key"))) for name, c in flat]
    broken = df.filter(reduce(lambda a, b: a | b, [c.broken for _, c in flat]))
    found = broken.select(F.explode(F.array(*finding)).alias("f")).filter("f IS NOT NULL")
    return found.groupBy("f.check", "f.key").agg(F.count(F.lit(1)).alias("rows"))


def violation_report(checks: Mapping[str, DataFrame], *found: DataFrame) -> DataFrame:
    """All findings as (check, key, rows); composite keys are joined by a comma. ``found`` are reports already, as
    from ``column_findings``."""
    parts = [*found]
    parts += [
        offending.select(
            F.lit(name).alias("check"),
            F.concat_ws(",", *[F.col(c).cast("string") for c in offending.columns if c != "rows"]).alias("key"),
            F.col("rows").cast("long").alias("rows"),
        )
        for name, offending in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)
