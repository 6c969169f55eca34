"""Tables from literal rows, views, JSON documents and databases."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def typed_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def inferred_table(spark: SparkSession, rows: Iterable[Sequence], names: Sequence[str]) -> DataFrame:
    """Types taken from the values: whole numbers become long, text becomes string, all nullable."""
    return spark.createDataFrame(list(rows), list(names))


def line_table(spark: SparkSession, lines: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "line string")


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """A whole-file JSON document, or None if there is none at ``path``."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.json(path)
        df.schema
        return df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def jdbc_scan_options(
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **extra}
    if split_column is not None:
        if bounds is None:
            raise ValueError("a split column needs its lowest and highest value")
        options.update(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_jdbc(spark: SparkSession, columns: Sequence[str], **options) -> DataFrame:
    """Scan of a database table. Columns and filters reach the database; with ``split_column`` the scan runs in
    ``partitions`` parallel ranges instead of one connection."""
    return spark.read.format("jdbc").options(**jdbc_scan_options(**options)).load().select(*columns)
