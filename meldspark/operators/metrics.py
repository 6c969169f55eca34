"""Counts that describe a consolidation run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SECTIONS = ("rows_read", "rejected", "valid_rows", "merged_duplicates", "customers_loaded")


def rows_by_source(checked: DataFrame) -> DataFrame:
    """Rows per source, most trusted source first."""
    return (
        checked.groupBy("source")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("source_priority").alias("priority"))
        .orderBy("priority")
        .select("source", "rows")
    )


def rows_by_reason(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason, most frequent first, ties by reason."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "reason")


def run_summary(checked: DataFrame, customers: DataFrame) -> DataFrame:
    """(metric, item, rows): rows read per source, rejected per reason, and the totals.

    valid = read - rejected and merged = valid - loaded. One pass over the checked rows; everything after the
    first aggregate works on a few dozen rows.
    """
    counts = checked.groupBy("source", "source_priority", "reject_reason").agg(F.count(F.lit(1)).alias("n"))
    n, reason = F.col("n"), F.col("reject_reason")

    def entry(metric: str, item, rows, rank):
        return F.struct(
            F.lit(metric).alias("metric"), item.alias("item"), rows.cast("long").alias("rows"),
            rank.cast("int").alias("rank"),
        )

    none = F.lit("")
    zero = F.lit(0)
    from_rows = counts.select(
        F.explode(
            F.array(
                entry("rows_read", F.col("source"), n, F.col("source_priority")),
                entry("rejected", F.coalesce(reason, none), F.when(reason.isNotNull(), n), zero),
                entry("valid_rows", none, F.when(reason.isNull(), n).otherwise(0), zero),
                entry("merged_duplicates", none, F.when(reason.isNull(), n).otherwise(0), zero),
            )
        ).alias("e")
    )
    loaded = customers.agg(F.count(F.lit(1)).alias("n")).select(
        F.explode(
            F.array(entry("customers_loaded", none, n, zero), entry("merged_duplicates", none, -n, zero))
        ).alias("e")
    )
    section = F.array_position(F.array(*[F.lit(s) for s in _SECTIONS]), F.col("metric"))
    return (
        from_rows.unionByName(loaded)
        .select("e.*")
        .filter(F.col("rows").isNotNull())
        .groupBy("metric", "item")
        .agg(F.sum("rows").alias("rows"), F.min("rank").alias("rank"))
        .orderBy(section, "rank", F.desc("rows"), "item")
        .select("metric", "item", "rows")
    )
