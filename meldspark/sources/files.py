"""File readers. Schemas are always declared, so nothing is inferred and only needed columns are read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from meldspark.sources.heads import files_by_head
from meldspark.sources.numbering import POSITION, number_source_rows, with_file_position


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def _finish(df: DataFrame, numbered: bool) -> DataFrame:
    return number_source_rows(df) if numbered else df


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    sep: str = ";",
    header: bool = True,
    multi_line: bool = False,
    numbered: bool = False,
    positioned: bool = False,
) -> DataFrame:
    """Delimited text, every column as text; quotes are doubled inside quoted fields.

    With a header, columns are found by their names in any order and among others, in each file by its own header:
    files are grouped by header and the groups read together. A file without one of the columns fails, and so does a
    line with too many or too few fields.
    ``multi_line`` allows line ends inside quotes at the price of unsplittable files. ``numbered`` adds ``source_row``;
    ``positioned`` adds the position columns instead, from which rows can be numbered later.
    """
    options = dict(sep=sep, quote='"', escape='"', header=header, multiLine=multi_line, mode="FAILFAST")
    groups: list[list[str]] = [[path]]
    if header and len(spark.read.text(path).inputFiles()) > 1:
        found = files_by_head(spark, path, r"^(.*?)\s*$")
        groups = [files for _, files in found] if len(found) > 1 else groups
    parts = [_with_header(spark, files, columns, options, numbered or positioned) for files in groups]
    return _finish(reduce(DataFrame.unionByName, parts), numbered)


def _with_header(
    spark: SparkSession, paths: list[str], columns: Sequence[str], options: dict, positioned: bool
) -> DataFrame:
    """The columns of files that have the same header, or none."""
    present = spark.read.options(**options).csv(paths).columns if options["header"] else []
    if missing := [c for c in columns if present and c not in present]:
        raise ValueError(f"no column {', '.join(missing)} in the header of {paths[0]}")
    reader = spark.read.schema(text_schema(present or columns)).options(**options, enforceSchema=not present)
    rows = reader.csv(paths)
    if positioned:
        rows = with_file_position(rows)
    return rows.select(*columns, *[c for c in POSITION if c in rows.columns])


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str, numbered: bool = False, positioned: bool = False
) -> DataFrame:
    """One JSON object per line under a declared, possibly nested schema. Text fields take any JSON scalar."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return _finish(with_file_position(rows) if numbered or positioned else rows, numbered)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as one column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")
