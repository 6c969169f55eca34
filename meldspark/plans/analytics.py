"""Country and company analytics, as DataFrames and as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldspark.functions.classify import WEALTH_CLASSES, WEALTH_REST, class_at_least, ratio_class
from meldspark.operators.grouping import class_stats, groups_with_at_least, text_by_group


def with_wealth(
    df: DataFrame, amount: str, heads: str, floors: Sequence[tuple[float, str]] = WEALTH_CLASSES, rest: str = WEALTH_REST
) -> DataFrame:
    """Adds the amount per head, rounded to one decimal, and the class of that rounded value."""
    return df.withColumn("per_head", F.round(F.col(amount) / F.col(heads), 1)).withColumn(
        "wealth", class_at_least(F.col("per_head"), floors, rest)
    )


def with_exact_wealth(
    df: DataFrame, amount: str, heads: str, floors: Sequence[tuple[float, str]] = WEALTH_CLASSES, rest: str = WEALTH_REST
) -> DataFrame:
    """Adds the class of the exact ratio."""
    return df.withColumn("wealth", ratio_class(F.col(amount), F.col(heads), False, floors, rest))


def wealth_listing(classed: DataFrame) -> DataFrame:
    """Highest amount per head first; rows with the same rounded amount by a hash of the row, so that a frequent amount
    spreads over several ranges, and then by their columns, so that the order is always the same."""
    ties = [c for c in classed.columns if c != "per_head"]
    return classed.orderBy(F.desc("per_head"), F.xxhash64(*ties), *ties)


def wealth_stats(classed: DataFrame, heads: str) -> DataFrame:
    return class_stats(classed, "wealth", heads, "per_head", ("members", "total_heads", "mean_per_head"))


def wealth_stats_sql(spark: SparkSession, classed: DataFrame, heads: str) -> DataFrame:
    return spark.sql(
        f"""
        SELECT wealth, count(*) AS members, sum({heads}) AS total_heads, round(avg(per_head), 1) AS mean_per_head
        FROM {{classed}} GROUP BY wealth ORDER BY mean_per_head DESC
        """,
        classed=classed,
    )


def frequent_wealth(classed: DataFrame, group: str, at_least: int = 2) -> DataFrame:
    return groups_with_at_least(classed, [group, "wealth"], at_least, "members")


def frequent_wealth_sql(spark: SparkSession, classed: DataFrame, group: str, at_least: int = 2) -> DataFrame:
    return spark.sql(
        f"""
        SELECT {group}, wealth, count(*) AS members FROM {{classed}}
        GROUP BY {group}, wealth HAVING count(*) >= {int(at_least)} ORDER BY {group}, wealth
        """,
        classed=classed,
    )


def industries_outside(companies: DataFrame, home: str, at_least: int = 2, sep: str = ", ") -> DataFrame:
    """Industries with enough companies outside the home country, with the sorted company names. Companies without
    a country are left out, as a comparison with NULL is not true."""
    abroad = companies.filter(F.col("country") != home)
    return text_by_group(abroad, ["industry"], "name", sep, at_least).select(
        "industry", "part", F.col("rows").alias("companies"), F.col("text").alias("names")
    )
