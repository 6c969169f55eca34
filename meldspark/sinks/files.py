"""File writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.session import checkpointed
from meldspark.sources.numbering import with_range_places, written_with_numbers


def write_parquet(df: DataFrame, path: str | None) -> bool:
    """Replaces the Parquet table at ``path``; without a path nothing is written."""
    if path is None:
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_delimited(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",", header: bool = False
) -> None:
    """Delimited text of the chosen columns; quotes are doubled. The default is the headerless bulk-load form."""
    chosen = df.select(*columns) if columns else df
    chosen.write.options(
        sep=sep,
        header=header,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
    ).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_lines(df: DataFrame, path: str, column: str) -> None:
    df.select(column).write.text(path)


def sorted_output(df: DataFrame, *order: str, files: int | None = None) -> DataFrame:
    """Globally ordered table output: ranges of the key per file, sorted inside."""
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def write_yaml_stream(
    df: DataFrame, path: str, entry: str, order: Sequence[str], per_document: int = 5000, title: str | None = None
) -> None:
    """Text entries as a stream of documents with ``per_document`` list entries each, in the given order.

    One range shuffle sorts the entries; they are counted while the sorted ranges are written for the second pass,
    which only puts the borders in. The files in the order of their names are the stream: a document that is not full
    at the end of a file goes on in the next one, and each file is a valid stream by itself.
    """
    placed = with_range_places(df.select(*dict.fromkeys([*order, entry])), order)
    numbered = written_with_numbers(placed, lambda rows: checkpointed(rows, "yaml-ranges"), "_n")
    head = F.when(F.col("_n") == 1, F.lit(f"# {title}\n")).otherwise("") if title else F.lit("")
    opening = F.when((F.col("_n") - 1) % per_document == 0, F.concat(head, F.lit("---\n"))).otherwise("")
    numbered.select(F.concat(opening, F.col(entry)).alias("line")).write.text(path)
