"""Person and tax report."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.functions.classify import income_bracket
from meldspark.functions.text import full_name
from meldspark.operators.integrity import duplicate_keys, null_counts, violation_report
from meldspark.session import stage
from meldspark.sinks.files import write_parquet
from meldspark.sinks.jdbc import replace_jdbc_table
from meldspark.sources.tables import read_jdbc

# The name has the database's unbounded text type, as no width would hold every name.
REPORT_TYPES = "income_bracket VARCHAR(10)"


class RepeatedPerson(ValueError):
    """A person id occurs more than once; nothing was loaded."""


def person_tax_report(person: DataFrame, tax: DataFrame) -> DataFrame:
    """One row per person with a tax row: id, full name, income, bracket."""
    taxes = tax.select(F.col("id").alias("_tax_id"), F.col("income").cast("decimal(12,2)").alias("income"))
    return (
        person.select("id", "name", "last_name", "tax_id")
        .join(taxes, F.col("tax_id") == F.col("_tax_id"))
        .select(
            F.col("id").alias("person_id"),
            full_name("name", "last_name").alias("full_name"),
            "income",
            income_bracket(F.col("income")).alias("income_bracket"),
        )
    )


def run_person_tax(person: DataFrame, tax: DataFrame, load, parquet_path: str | None = None) -> DataFrame:
    """Computes the report once, hands it to ``load`` (a function that replaces the report table) and, if a path is
    given, writes the same rows as Parquet. The report is staged, so both outputs see equal rows; ``person_id`` is its
    key, and a repeated or missing one stops the run before anything is loaded."""
    report = stage(person_tax_report(person, tax), "person-tax")
    broken = violation_report(
        {
            "person_id key": duplicate_keys(report, ["person_id"]),
            "person_id required": null_counts(report, ["person_id"]),
        }
    )
    worst = broken.orderBy("check", "key").first()
    if worst is not None:
        raise RepeatedPerson(f"{broken.count()} findings, first {worst['check']}: {worst['key']} ({worst['rows']} rows)")
    load(report)
    write_parquet(report, parquet_path)
    return report


class JdbcSplit(NamedTuple):
    """A parallel scan of a table: ranges of ``column`` between the bounds, one connection each."""

    column: str
    bounds: tuple[int, int]
    partitions: int

    def options(self) -> dict:
        return {"split_column": self.column, "bounds": self.bounds, "partitions": self.partitions}


def run_person_tax_jdbc(
    spark,
    url: str,
    parquet_path: str | None = None,
    person_split: JdbcSplit | None = None,
    tax_split: JdbcSplit | None = None,
    **connection: str,
) -> DataFrame:
    """The same between tables of one database. Without a split a table is read over one connection by one task."""
    person_options, tax_options = (s.options() if s else {} for s in (person_split, tax_split))
    person = read_jdbc(
        spark, ["id", "name", "last_name", "tax_id"], url=url, table="person", **person_options, **connection
    )
    tax = read_jdbc(spark, ["id", "income"], url=url, table="tax", **tax_options, **connection)

    def load(report: DataFrame) -> None:
        replace_jdbc_table(report, url=url, table="report.person_tax", column_types=REPORT_TYPES, **connection)

    return run_person_tax(person, tax, load, parquet_path)
