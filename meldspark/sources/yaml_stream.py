"""Reader for multi-document YAML streams whose documents are lists of maps.

The text is split where a new list entry begins (a dash at the start of a line, behind as many blanks as the file's first
entry has), so a file splits into many tasks and a document of any length never has to fit into one of them. Files of a
folder are grouped by that indent, and each group is cut at its own. Entries in the plainest form become JSON text by built-in functions. Each task hands all others, batch by batch and rejoined
into a valid stream, to the YAML loader. Spark's JSON reader then gives the entries their declared, nested schema.
Anchors must not reach from one entry into another.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldspark.sources.heads import files_by_head
from meldspark.sources.numbering import FILE, PLACE, SPLIT, number_source_rows, with_file_position, with_place

# A key that isn't read as a truth value, and a value that reads the same as YAML and JSON: quoted text without escapes,
# control characters or line separators, a whole number, a truth value, null. ASCII is listed character by character: Java
# looks listed ones up in a table, but tries ranges one after the other, which took five times as long.
LETTERS, DIGITS = string.ascii_letters, string.digits
ASCII = "".join(c if c.isalnum() else f"\\{c}" for c in map(chr, range(0x20, 0x7F)) if c not in '"\\').replace("\\ ", " ")
KEY = rf"(?!(?i:yes|no|on|off|true|false|null):)[{LETTERS}_][{LETTERS}{DIGITS}_]*+"
TEXT = rf'"(?:[{ASCII}]++|[^\x00-\x9f\u2028\u2029\ufeff]++)*+"'
VALUE = rf"(?:{TEXT}|0|[1-9][{DIGITS}]*+|true|false|null)"


def plain_json(entry: Column, indent: str = "") -> Column:
    """JSON text of an entry in the plain form (maps nested once, four blanks deep), NULL for any other.

    One pattern decides. After it every line is known to begin with a key, so the steps that follow look at line starts only.
    """
    inner = rf"\n{indent}    {KEY}: {VALUE}"
    field = rf"{KEY}:(?: {VALUE}|(?:{inner})++|)"
    whole = rf"\A{field}(?:\n{indent}  {field})*+(?:\n---)?\n?\z"
    name = r"([^:\n]++)"
    # Neither a key nor a value ends in a dash or line end, so that is the document border.
    text = F.concat(F.lit(f"\n{indent}  "), F.rtrim(entry, F.lit("\n-")), F.lit("\n"))
    text = F.regexp_replace(text, rf"\n{indent}    {name}: ", ',"$1":')
    text = F.regexp_replace(text, rf"\n{indent}  {name}:,([^\n]*+)", f"\n{indent}  $1: {{$2}}")
    text = F.replace(text, F.lit(":\n"), F.lit(": null\n"))
    text = F.regexp_replace(text, rf"\n{indent}  {name}: ", ',"$1":')
    return F.when(entry.rlike(whole), F.concat(F.lit("{"), F.substring(text, F.lit(2), F.length(text) - 2), F.lit("}")))


def _entry_parser(indent: str = ""):
    """The ``mapInPandas`` worker, built as a closure so that workers need no module of ours."""

    def parse(batches):
        import itertools
        import json

        import pandas as pd
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def loaded_entries(chunks):
            for document in yaml.load_all("\n".join(chunks), Loader=loader):
                for entry in document or ():
                    yield json.dumps(entry, ensure_ascii=False, default=str)

        opened = None  # the file whose very first text has been seen; nothing was cut off in front of it
        for batch in batches:
            file, split = batch["_file"], batch["_split"]
            runs = (file.ne(file.shift()) | split.ne(split.shift())).cumsum()
            for _, run in batch.groupby(runs, sort=False):
                path, start = run["_file"].iloc[0], run["_split"].iloc[0]
                chunks = [(f"{indent}- {chunk}", plain) for chunk, plain in zip(run["value"], run["_json"])]
                if start == 0 and opened != path:
                    opened, chunks[0] = path, (run["value"].iloc[0], None)
                entries = []
                for is_plain, group in itertools.groupby(chunks, lambda chunk: chunk[1] is not None):
                    if is_plain:
                        entries.extend(entry for _, entry in group)
                    else:
                        entries.extend(loaded_entries([chunk for chunk, _ in group]))
                if entries:
                    yield pd.DataFrame({"entry": entries, "_file": path, "_split": start})

    return parse


def files_by_indent(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(blanks before a list entry, paths to read) of every group of files; none for a path without entries. A file is
    read no further than its first entry."""
    groups = files_by_head(spark, path, "^( *)- ")
    return [(groups[0][0], [path])] if len(groups) == 1 else groups


def entry_chunks(spark: SparkSession, paths: str | list[str], indent: str) -> DataFrame:
    """(value, _json, file, split) of every entry; the first text of a file may have a head instead."""
    chunks = with_file_position(spark.read.option("lineSep", f"\n{indent}- ").text(paths)).drop(PLACE)
    return chunks.withColumn("_json", plain_json(F.col("value"), indent))


def read_yaml_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, numbered: bool = False, positioned: bool = False
) -> DataFrame:
    """Every list entry as one row of ``schema``; a missing nested map gives NULL fields. ``numbered`` adds
    ``source_row``, ``positioned`` the position columns instead."""
    columns = f"entry string, {FILE} string, {SPLIT} long"
    parts = [
        entry_chunks(spark, paths, indent).mapInPandas(_entry_parser(indent), columns)
        for indent, paths in files_by_indent(spark, path) or [("", [path])]
    ]
    entries = reduce(DataFrame.unionByName, parts)
    parsed = entries.select(
        F.from_json("entry", schema, {"mode": "FAILFAST"}).alias("row"), FILE, SPLIT
    ).select("row.*", FILE, SPLIT)
    if numbered or positioned:
        return number_source_rows(with_place(parsed)) if numbered else with_place(parsed)
    return parsed.drop(FILE, SPLIT)
