"""Grouped statistics, filters on groups, text aggregation, word counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meldspark.session import stage

MAX_TEXT = 64_000_000


def count_where(df: DataFrame, condition: Column, name: str = "rows") -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def class_stats(
    df: DataFrame, by: str, total_of: str, mean_of: str, names: Sequence[str], digits: int = 1
) -> DataFrame:
    """Rows, sum and rounded mean per class, highest mean first."""
    rows, total, mean = names
    return (
        df.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias(rows),
            F.sum(total_of).alias(total),
            F.round(F.avg(mean_of), digits).alias(mean),
        )
        .orderBy(F.desc(mean))
    )


def groups_with_at_least(df: DataFrame, keys: Sequence[str], rows: int, name: str = "rows") -> DataFrame:
    """Group sizes, small groups left out, in key order."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) >= rows).orderBy(*keys)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """How often each word occurs, most frequent first, ties by word."""
    from meldspark.functions.text import words

    return (
        df.select(F.explode(words(text)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "word")
    )


def surplus_rows(df: DataFrame, key: str, name: str = "surplus") -> DataFrame:
    """Rows minus distinct keys; zero means the key is unique."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.col(key))).alias(name))


def text_by_group(
    df: DataFrame, keys: Sequence[str], value: str, sep: str = ", ", min_rows: int = 1, max_text: int = MAX_TEXT
) -> DataFrame:
    """All values of each group with at least ``min_rows`` rows, sorted, joined by ``sep``: (keys, part, rows, text).

    Group sizes are measured first. If every text fits into ``max_text`` characters, one aggregate does it and
    ``part`` is always 1. Otherwise long groups come out in several numbered parts of about that length, so
    that no task holds a whole oversized group; joining the parts gives the full text. Both ways give the same groups:
    NULL is a key like any other, and a group whose values are all NULL has one part with an empty text.
    """
    width = F.length(value) + len(sep)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("_chars"))
    sizes = sizes.filter(F.col("rows") >= min_rows)
    longest = sizes.agg(F.max("_chars")).first()[0] or 0
    if longest <= max_text:
        return (
            df.groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.array_join(F.array_sort(F.collect_list(value)), sep).alias("text"),
            )
            .filter(F.col("rows") >= min_rows)
            .select(*keys, F.lit(1).cast("long").alias("part"), "rows", "text")
        )
    return _text_in_parts(df, keys, value, sep, sizes, max_text)


def _text_in_parts(
    df: DataFrame, keys: Sequence[str], value: str, sep: str, sizes: DataFrame, max_text: int
) -> DataFrame:
    # Equal values are counted first and written out again in bounded runs, so copies cannot pile up either.
    copies = F.greatest(F.lit(1), F.floor(F.lit(max_text) / (F.length(value) + len(sep))))
    runs = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_copies", copies)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / F.col("_copies")))))
        .withColumn("_n", F.least(F.col("_copies"), F.col("_n") - F.col("_i") * F.col("_copies")).cast("int"))
        .withColumn("_chars", F.col("_n") * (F.length(value) + len(sep)))
        .orderBy(*keys, value, "_i")
        .withColumn("_range", F.spark_partition_id())
    )
    runs = stage(runs.select(*keys, value, "_i", "_n", "_chars", "_range"), "text-runs")
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    bases = runs.groupBy(*keys, "_range").agg(F.sum("_chars").alias("_range_chars"))
    bases = bases.select(*keys, "_range", F.coalesce(F.sum("_range_chars").over(before), F.lit(0)).alias("_base"))
    runs = _join_null_safe(runs, bases, [*keys, "_range"], "inner")
    inside = W.partitionBy(*keys, "_range").orderBy(value, "_i").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("_chars").over(inside), F.lit(0))
    piece = F.array_join(F.array_repeat(F.col(value), F.col("_n")), sep)
    pieces = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), "_i", piece.alias("t"))))
    parts = (
        runs.withColumn("part", F.floor(start / max_text) + 1)
        .groupBy(*keys, "part")
        .agg(pieces.alias("_pieces"))
        .select(*keys, "part", F.array_join(F.col("_pieces.t"), sep).alias("text"))
    )
    part = F.coalesce("part", F.lit(1).cast("long")).alias("part")
    return _join_null_safe(sizes.select(*keys, "rows"), parts, keys, "left").select(
        *keys, part, "rows", F.coalesce("text", F.lit("")).alias("text")
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the key columns of the left side stay."""
    other = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_of_{k}" for k in keys])
