"""Database writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jdbc_write_options(
    url: str, table: str, batch_rows: int = 10_000, writers: int = 8, column_types: str | None = None, **extra: str
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(writers), **extra}
    if column_types:
        options["createTableColumnTypes"] = column_types
    return options


def replace_jdbc_table(df: DataFrame, **options) -> None:
    """Drops, creates and fills a database table: every executor writes batches over its own connection, at most
    ``writers`` at a time. Rerunning replaces the rows."""
    df.write.format("jdbc").options(**jdbc_write_options(**options)).mode("overwrite").save()


def replace_table(df: DataFrame, name: str) -> None:
    """Creates or replaces a table of the session's catalog."""
    df.write.mode("overwrite").saveAsTable(name)
