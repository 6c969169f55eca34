"""Session defaults and the shared staging area."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites recorded for every column expression triple the time it takes to build a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Methods above 8000 bytes of bytecode are never compiled by the JIT; wide projections then run split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The merge keeps one object buffer per key; the stock value of 128 keys makes every task sort.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}

MAX_BROADCAST_ROWS = 200_000

_staged: list[str] = []


def build_session(app_name: str = "meldspark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the defaults above; ``settings`` uses ``__`` for dots and wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> str:
    """Sends this package to all workers, now and later ones; for clusters where it is neither installed nor submitted with
    ``--py-files``. Functions that run in tasks are pickled by reference, so workers have to import it."""
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="meldspark-"), "meldspark"), "zip", os.path.dirname(root), os.path.basename(root)
    )
    spark.sparkContext.addPyFile(archive)
    return archive


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    directory = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if directory:
        return directory.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="meldspark-"))
    return context.getCheckpointDir().rstrip("/")


def new_shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once as Parquet in the shared folder and reads it back.

    The result has no lineage to the inputs, survives lost executors, and later readers scan only the
    columns they need. Used where a table feeds several outputs or must not change between two passes.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    _staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as it is partitioned, for a second pass that needs the same rows in the same partitions and
    in the partitions' order, which a staged table does not keep. Its files count as a staged table."""
    spark = df.sparkSession
    context = spark.sparkContext
    shared_dir(spark)
    before = context.getCheckpointDir()
    path = new_shared_path(spark, label)
    _staged.append(path)
    context.setCheckpointDir(path)
    try:
        return df.checkpoint()
    finally:
        if before:
            context.setCheckpointDir(before.rstrip("/").rsplit("/", 1)[0])  # the context adds a folder of its own


def staged_tables() -> list[str]:
    """Paths of the tables staged by this driver and not yet removed, in order."""
    return list(_staged)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_staged(spark: SparkSession, since: int = 0, keep_last: bool = False) -> int:
    """Deletes the tables staged by this driver (from number ``since`` on, the newest one excepted if ``keep_last``) and
    returns how many. For the end of a run: results that still read them can't be computed any more."""
    paths = _staged[since:-1] if keep_last else _staged[since:]
    for path in paths:
        delete_path(spark, path)
        _staged.remove(path)
    return len(paths)


def spread(df: DataFrame) -> DataFrame:
    """Shuffles a table with fewer input splits than cores before heavy per-row work; larger inputs pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def broadcast_if_small(df: DataFrame, rows: int | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a counted size: beyond ``max_rows`` the join is left to a shuffle (AQE splits skew).

    ``rows`` is the size if the caller has counted already or made the table from driver-side rows.
    """
    if rows is None:
        rows = df.count()  # partial counts per task; a limit would send up to max_rows rows per task to one place
    return F.broadcast(df) if rows <= max_rows else df
