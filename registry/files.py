"""Round trips through every file format, in new folders below the shared staging folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from meldspark.functions.text import json_quoted
from meldspark.plans.customers import (
    CRM_COLUMNS,
    CRM_FILE,
    LEGACY_FILE,
    WEBSHOP_FILE,
    consolidate_files,
)
from meldspark.plans.exports import MEMBER_LINES, member_entry
from meldspark.session import new_shared_path, stage
from meldspark.sinks.files import (
    sorted_output,
    write_delimited,
    write_json_lines,
    write_lines,
    write_parquet,
    write_yaml_stream,
)
from meldspark.sources.files import read_delimited, read_json_lines, read_lines, read_parquet
from meldspark.sources.yaml_stream import read_yaml_stream
from registry import query, table
from registry.customers import CTES
from registry.raw_sources import crm_rows, legacy_rows, webshop_rows


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || '; \"' || c_mktsegment || '\"' AS c_name FROM customer")
def csv_roundtrip(spark, sf_dir):
    """Separators and quotes inside fields survive; columns are found by the header, whatever their order."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.concat("c_name", F.lit('; "'), "c_mktsegment", F.lit('"')).alias("c_name"),
    )
    path = new_shared_path(spark, "csv")
    write_delimited(rows, path, ["c_name", "c_custkey"], sep=";", header=True)
    return read_delimited(spark, path, rows.columns)


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text FROM documents")
def csv_long_texts(spark, sf_dir):
    """S4 with line ends inside quoted fields: whole documents."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    path = new_shared_path(spark, "csv-texts")
    write_delimited(rows.repartition(8), path, sep=";", header=True)
    return read_delimited(spark, path, rows.columns, multi_line=True)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders
""")
def csv_other_headers(spark, sf_dir):
    """S4 with files of different headers in one folder: three column orders, one with a further column."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    path = new_shared_path(spark, "csv-headers")
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    for number, order in enumerate((columns, columns[::-1], ["o_orderstatus", "o_orderkey", "o_custkey", "o_orderpriority"])):
        part = orders.filter(F.crc32(F.col("o_orderkey").cast("binary")) % 3 == number)
        write_delimited(part, f"{path}/{number}", order, sep=";", header=True)
    return read_delimited(spark, f"{path}/*", columns)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority AS priority FROM orders")
def csv_headerless(spark, sf_dir):
    """K3: chosen columns without a header, as for a bulk load."""
    path = new_shared_path(spark, "csv-bulk")
    write_delimited(table(spark, sf_dir, "orders"), path, ["o_orderkey", "o_custkey", "o_orderpriority"])
    return read_delimited(spark, path, ["key", "customer", "priority"], sep=",", header=False)


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price, o_orderpriority AS priority FROM orders
""")
def jsonl_roundtrip(spark, sf_dir):
    """Nested objects; numbers are read as text under the declared schema."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.col("o_orderpriority").alias("priority")
        ).alias("detail"),
        F.col("o_orderstatus").alias("status"),
    )
    path = new_shared_path(spark, "jsonl")
    write_json_lines(rows, path)
    schema = "id string, detail struct<price: string, priority: string>, status string"
    return read_json_lines(spark, path, schema).select("id", "status", "detail.price", "detail.priority")


@query("""
    SELECT row_number() OVER (ORDER BY conv_id, turn) AS source_row, CAST(conv_id AS VARCHAR) AS conv_id,
           if(turn = 0, NULL, role) AS role, if(turn = 0, NULL, text) AS text FROM conversations
""")
def yaml_roundtrip(spark, sf_dir):
    """Whole texts as quoted scalars, missing nested maps, rows numbered in stream order."""
    detail = F.concat(
        F.lit("\n  said:\n    role: "), json_quoted("role"), F.lit("\n    text: "), json_quoted("text")
    )
    rows = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.concat(
            F.lit("- conv: "), F.col("conv_id").cast("string"), F.when(F.col("turn") != 0, detail).otherwise("")
        ).alias("entry"),
    )
    path = new_shared_path(spark, "yaml")
    write_yaml_stream(rows, path, "entry", ["conv_id", "turn"], per_document=100, title="Conversations")
    read = read_yaml_stream(spark, path, "conv string, said struct<role: string, text: string>", numbered=True)
    return read.select("source_row", F.col("conv").alias("conv_id"), "said.role", "said.text")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
""")
def yaml_other_indents(spark, sf_dir):
    """S6 with files of different indents in one folder, each cut at its own."""
    customers = table(spark, sf_dir, "customer")
    path = new_shared_path(spark, "yaml-indents")
    for number, indent in enumerate(("", "  ", "    ")):
        fields = [F.lit(f"{indent}- key: "), F.col("c_custkey").cast("string"), F.lit(f"\n{indent}  of:\n{indent}    name: ")]
        fields += [json_quoted("c_name"), F.lit(f"\n{indent}    segment: "), json_quoted("c_mktsegment")]
        part = customers.filter(F.col("c_custkey") % 3 == number).select("c_custkey", F.concat(*fields).alias("entry"))
        write_yaml_stream(part, f"{path}/{number}", "entry", ["c_custkey"], per_document=200)
    read = read_yaml_stream(spark, f"{path}/*", "key string, of struct<name: string, segment: string>")
    return read.select(F.col("key").alias("c_custkey"), F.col("of.name").alias("c_name"), F.col("of.segment").alias("c_mktsegment"))


@query("SELECT * FROM part")
def parquet_roundtrip(spark, sf_dir):
    """K2 S11"""
    path = new_shared_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "part"), path)
    return read_parquet(spark, path)


@query("SELECT replace(replace(html, chr(13), ' '), chr(10), ' ') AS line FROM pages")
def lines_roundtrip(spark, sf_dir):
    """One line per page."""
    path = new_shared_path(spark, "lines")
    lines = table(spark, sf_dir, "pages").select(F.regexp_replace("html", "[\r\n]", " ").alias("line"))
    write_lines(lines, path, "line")
    return read_lines(spark, path)


@query("""
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS source_row,
      CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
      CAST(l_partkey AS VARCHAR) AS l_partkey
    FROM lineitem
""")
def source_row_numbers(spark, sf_dir):
    """1-based positions over many sorted files."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    path = new_shared_path(spark, "csv-numbered")
    rows = sorted_output(table(spark, sf_dir, "lineitem").select(*order), *order, files=24)
    write_delimited(rows, path, ["l_orderkey", "l_linenumber", "l_partkey"], sep=";", header=True)
    return read_delimited(spark, path, ["l_orderkey", "l_linenumber", "l_partkey"], numbered=True)


def write_raw_sources(spark, sf_dir, folder):
    """The three raw sources as files in their own formats and in row order."""
    crm, webshop, legacy = (f(spark, sf_dir) for f in (crm_rows, webshop_rows, legacy_rows))
    write_delimited(sorted_output(crm, "source_row"), f"{folder}/{CRM_FILE}", CRM_COLUMNS, sep=";", header=True)
    write_json_lines(sorted_output(webshop, "source_row").drop("source_row"), f"{folder}/{WEBSHOP_FILE}")
    paths = {"email": "contact.email", "phone": "contact.phone"}
    paths |= {field: f"location.{field}" for field in ("street", "city", "postcode", "country")}
    values = {field: json_quoted(paths.get(field, field)) for _, field in MEMBER_LINES if field}
    # Staged, because the sort reads its input twice and the entries cost more than it does.
    members = stage(legacy.select("source_row", member_entry(values).alias("entry")), "members")
    write_yaml_stream(
        members, f"{folder}/{LEGACY_FILE}", "entry", ["source_row"], per_document=700, title="Members"
    )


@query(f"{CTES} SELECT * FROM merged")
def customers_from_files(spark, sf_dir):
    """The whole job from CSV, JSON Lines and YAML files to merged customers."""
    folder = new_shared_path(spark, "sources")
    write_raw_sources(spark, sf_dir, folder)
    return consolidate_files(spark, folder).customer


@query(f"""
    {CTES} SELECT source, source_row, customer_id_text AS customer_id, reject_reason AS reason
    FROM checked WHERE reject_reason IS NOT NULL
""")
def rejects_from_files(spark, sf_dir):
    """The rejected rows of the same job, with their positions in the files."""
    folder = new_shared_path(spark, "sources")
    write_raw_sources(spark, sf_dir, folder)
    return consolidate_files(spark, folder).rejected_row
