"""What the first lines of files say about how to read them, for folders whose files differ.

Spark lists the files of a path in the driver before it reads them; for up to ``DRIVER_FILES`` of them the driver also
opens each, several at a time, and reads up to the first fitting line. More files are opened by one task each, which
stops at that line too. So no file is read further than its head.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DRIVER_FILES = 512
THREADS = 16


def as_path(file: str) -> str:
    """The path that reads just this file: Spark reports names as URIs and reads paths as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def _opened(spark: SparkSession, file: str):
    """A line reader of the file, unpacked if its name says that it is packed."""
    hadoop, jvm = spark._jvm.org.apache.hadoop, spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(unquote(file))
    stream = path.getFileSystem(conf).open(path)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    if codec is not None:
        stream = codec.createInputStream(stream)
    return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))


def _heads_in_driver(spark: SparkSession, files: list[str], head: re.Pattern) -> Iterator[tuple[str, str]]:
    def first(file: str) -> str | None:
        lines = _opened(spark, file)
        try:
            while (line := lines.readLine()) is not None:
                if found := head.match(line):
                    return found[1]
            return None
        finally:
            lines.close()

    with ThreadPoolExecutor(THREADS) as pool:
        yield from ((f, found) for f, found in zip(files, pool.map(first, files)) if found is not None)


@contextmanager
def _settings(spark: SparkSession, **values: str):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _heads_in_tasks(spark: SparkSession, path: str, head: re.Pattern) -> Iterator[tuple[str, str]]:
    pattern = head.pattern

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = pc.index(pc.match_substring_regex(batch.column(0), pattern), True).as_py()
            if place >= 0:
                yield batch.slice(place, 1)
                return

    one_file_a_task = {
        "spark.sql.files.maxPartitionBytes": str(1 << 62),
        "spark.sql.files.openCostInBytes": str(1 << 62),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    }
    with _settings(spark, **one_file_a_task):
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
        for row in lines.mapInArrow(first, lines.schema).collect():  # one short row per file
            yield row["file"], head.match(row["value"])[1]


def files_by_head(spark: SparkSession, path: str, head: str) -> list[tuple[str, list[str]]]:
    """(head, paths) for every different head, each in path order. ``head`` is a pattern for the start of a line; the first
    line of a file that it matches gives what its group matches. Files without such a line are left out."""
    pattern = re.compile(head)
    files = spark.read.text(path).inputFiles()
    few = len(files) <= DRIVER_FILES
    found = _heads_in_driver(spark, files, pattern) if few else _heads_in_tasks(spark, path, pattern)
    groups = defaultdict(list)
    for file, value in sorted(found):
        groups[value].append(as_path(file))
    return list(groups.items())
