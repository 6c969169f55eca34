"""Replacing several related tables at once.

Every run writes its tables to new folders, checks what was written, and only then appends one commit row.
Readers follow the newest commit, so they see all tables of a run or none, also on object stores without
rename. A failed check leaves the previous tables in place. ``remove_old_runs`` deletes what no commit in use names.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldspark.session import delete_path

COMMIT_SCHEMA = "sequence long, run string, tables array<string>"
SHOWN = 20  # violations named in the error itself; the written report has all


class RejectedPublish(ValueError):
    """The written tables broke a constraint; nothing was committed."""


class LostRace(RuntimeError):
    """Another publisher committed first; publish again on top of its commit."""


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True).json(f"{root}/commits")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _newest(spark: SparkSession, root: str):
    commits = _commits(spark, root)
    return None if commits is None else commits.orderBy(F.desc("sequence"), "run").first()


def _commit(spark: SparkSession, root: str, sequence: int, run: str, tables: list[str]) -> None:
    """Writes the commit under its sequence number, which fails if another publisher has taken it. Where a store lets
    both write at the same moment, both see it afterwards, and readers and writers agree on the smaller run id."""
    row = spark.createDataFrame([(sequence, run, tables)], COMMIT_SCHEMA).coalesce(1)
    try:
        row.write.mode("errorifexists").json(f"{root}/commits/{sequence:012d}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_ALREADY_EXISTS":
            raise LostRace(f"commit {sequence} below {root} was made by another publisher") from error
        raise
    newest = _newest(spark, root)
    if newest["sequence"] == sequence and newest["run"] != run:
        raise LostRace(f"commit {sequence} below {root} was made by another publisher")


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    violations: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
) -> str:
    """Writes ``tables`` in order (parents first) below ``root`` and commits them together; returns the run id.

    ``violations`` gets the written tables and returns (check, key, rows); any row stops the commit. All of them
    are written beside the run, the error names their number and the first few. Of two publishers that start from
    the same commit, one gets ``LostRace``.
    """
    spark = next(iter(tables.values())).sparkSession
    run = uuid.uuid4().hex
    last = _newest(spark, root)
    written = {}
    for name, df in tables.items():
        path = f"{root}/{name}/{run}"
        df.write.parquet(path)
        written[name] = spark.read.schema(df.schema).parquet(path)
    if violations is not None:
        path = f"{root}/violations/{run}"
        found = violations(written)
        found.write.json(path)
        found = spark.read.schema(found.schema).json(path)
        total = found.count()
        if total:
            first = found.orderBy("check", "key").limit(SHOWN).collect()
            shown = "; ".join(f"{r['check']}: {r['key']} ({r['rows']} rows)" for r in first)
            raise RejectedPublish(f"{total} violations, all in {path}; first: {shown}")
    _commit(spark, root, 1 if last is None else last["sequence"] + 1, run, list(tables))
    return run


def current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table as of the newest commit."""
    last = _newest(spark, root)
    if last is None:
        raise LookupError(f"nothing was published below {root}")
    return spark.read.parquet(f"{root}/{table}/{last['run']}")


def _folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, hours since the last change) of the folders in ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    now = time.time()
    found = [f for f in system.listStatus(target) if f.isDirectory()]
    return [(f.getPath().getName(), (now - f.getModificationTime() / 1000) / 3600) for f in found]


def remove_old_runs(spark: SparkSession, root: str, keep: int = 2, hours: float = 24.0) -> list[str]:
    """Deletes the runs below ``root`` that no commit in use names, and returns their ids.

    In use are the newest ``keep`` commits, so whoever has opened the tables before the last publish can go on reading.
    Runs without a commit stay for ``hours`` after their last change: they may belong to a publisher still at work; after that they are
    left over from a failed or rejected one. The commits themselves stay, they are a line each and number the next one.
    """
    if keep < 1:
        raise ValueError("the newest commit is always in use")
    commits = _commits(spark, root)
    named = [] if commits is None else [r["run"] for r in commits.orderBy(F.desc("sequence"), "run").select("run").collect()]
    in_use, old = set(named[:keep]), set(named[keep:])
    removed = set()
    for table, _ in _folders(spark, root):
        if table == "commits":
            continue
        for run, age in _folders(spark, f"{root}/{table}"):
            if run not in in_use and (run in old or age >= hours):
                delete_path(spark, f"{root}/{table}/{run}")
                removed.add(run)
    return sorted(removed)
