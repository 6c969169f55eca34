"""Dense row numbers without pulling the rows through one task.

Rows carry their position (file, split, place in the task) from the reader on. Once they are staged, one small table
counts rows per split; running totals over it give every split its first number, and a lookup by split adds it
to those rows that need it. The stage keeps the positions fixed: both passes read the same written table, whatever the
cluster's size then. The data rows are never shuffled for it: the lookup table has one row of two numbers per split and
is broadcast up to ``MAX_SPLITS`` of them, which at 128 MB a split is half a petabyte.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meldspark.session import broadcast_if_small, stage

FILE, SPLIT, PLACE = "_file", "_split", "_place"
POSITION = (FILE, SPLIT, PLACE)
MAX_SPLITS = 4_000_000


def with_file_position(df: DataFrame) -> DataFrame:
    """Adds file path, split start and place; call directly on a file reader's DataFrame."""
    return with_place(
        df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT))
    )


def with_place(df: DataFrame) -> DataFrame:
    """The place of a row among those that its task reads, increasing in reading order."""
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def split_shifts(staged: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """(_key, _shift): what to add to a row's place to get its number, by split; numbers start anew for each value of
    ``within``. ``staged`` has the position columns."""
    counts = staged.groupBy(*within, FILE, SPLIT).agg(F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # Running totals: inside each file by split, then over files. These rows are one per split and one per
    # file, which the driver lists anyway; the data rows never meet in one task.
    in_file = W.partitionBy(*within, FILE).orderBy(SPLIT).rowsBetween(W.unboundedPreceding, -1)
    over_files = W.partitionBy(*within).orderBy(FILE).rowsBetween(W.unboundedPreceding, -1)
    sized = counts.withColumn("_split_base", F.coalesce(F.sum("_rows").over(in_file), F.lit(0)))
    files = counts.groupBy(*within, FILE).agg(F.sum("_rows").alias("_file_rows"))
    files = files.select(*within, FILE, F.coalesce(F.sum("_file_rows").over(over_files), F.lit(0)).alias("_file_base"))
    shift = F.col("_file_base") + F.col("_split_base") - F.col("_first") + 1
    return sized.join(files, [*within, FILE]).select(_split_key().alias("_key"), shift.alias("_shift"))


def _split_key() -> Column:
    return F.xxhash64(FILE, SPLIT)


def add_numbers(positioned: DataFrame, shifts: DataFrame, name: str) -> DataFrame:
    """Replaces the position columns by the row's number."""
    splits, keys = shifts.agg(F.count(F.lit(1)), F.count_distinct("_key")).first()
    if splits != keys:
        raise RuntimeError("two splits have the same hash; rename a file")
    return (
        positioned.join(broadcast_if_small(shifts, splits, MAX_SPLITS), _split_key() == F.col("_key"))
        .withColumn(name, F.col(PLACE) + F.col("_shift"))
        .drop(*POSITION, "_key", "_shift")
    )


def number_source_rows(positioned: DataFrame, name: str = "source_row") -> DataFrame:
    """1-based position of every row in its source, files taken in path order.

    ``positioned`` comes from ``with_file_position``, possibly followed by steps that keep row order
    (projections, ``mapInPandas``).
    """
    staged = stage(positioned, name)
    return add_numbers(staged, stage(split_shifts(staged), f"{name}-splits"), name)


def with_range_places(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` in the given order, with the range (``SPLIT``) and the place in it of every row.

    Rows that tie are ordered by a hash of the whole row, so a frequent value of the order columns still spreads over
    several ranges. Fully equal rows, for which any order is the same, are spread by where they were read.
    """
    return (
        df.withColumn(PLACE, F.monotonically_increasing_id())
        .orderBy(*order, F.xxhash64(*df.columns), PLACE)
        .withColumn(SPLIT, F.spark_partition_id().cast("long"))
        .withColumn(PLACE, F.monotonically_increasing_id())
    )


def written_with_numbers(placed: DataFrame, write: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Writes the result of ``with_range_places`` by ``write`` and replaces the places in what it returns by numbers.

    The rows of each range are counted while they are written: a histogram that has room for every range counts exactly,
    and has one entry per range. So neither the data nor what was written is read again for it.
    """
    spark = placed.sparkSession
    room = int(spark.conf.get("spark.sql.shuffle.partitions")) + 2
    totals = Observation()
    sizes = F.histogram_numeric(SPLIT, F.lit(room)).alias("sizes")
    written = write(placed.observe(totals, sizes, F.count(F.lit(1)).alias("rows")))
    counted = sorted((int(r["x"]), int(r["y"])) for r in totals.get["sizes"] or ())
    if len(counted) >= room or sum(rows for _, rows in counted) != totals.get["rows"]:
        raise RuntimeError("the written ranges were not counted exactly")
    shifts, number = [], 1
    for split, rows in counted:
        shifts.append((split, number - (split << 33)))  # places in partition p begin at p * 2**33
        number += rows
    lookup = F.broadcast(spark.createDataFrame(shifts, "_key long, _shift long"))  # one row per range
    numbered = written.join(lookup, F.col(SPLIT) == F.col("_key"))
    return numbered.withColumn(name, F.col(PLACE) + F.col("_shift")).drop(SPLIT, PLACE, "_key", "_shift")


def number_in_order(df: DataFrame, order: Sequence[str | Column], name: str = "id") -> DataFrame:
    """Surrogate key 1..n in the given order: a range shuffle and running totals, no single-task sort. The numbers do not
    depend on the partitioning."""
    return written_with_numbers(with_range_places(df, order), lambda placed: stage(placed, name), name)
