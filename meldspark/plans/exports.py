"""Writing customer records in the conventions of the three sources, and generating whole test sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meldspark.functions.text import json_quoted, money_text
from meldspark.operators.generate import (
    country_pools,
    manifest,
    overlap_pool,
    synthetic_customers,
    with_defects,
    with_overlap,
)
from meldspark.plans.customers import CRM_COLUMNS, CRM_FILE, LEGACY_FILE, MANIFEST_FILE, WEBSHOP_FILE
from meldspark.session import stage
from meldspark.sinks.files import write_delimited, write_lines, write_yaml_stream
from meldspark.sources.countries import country_dictionary

ORDER = ("record_id", "copy")


def crm_rows(records: DataFrame) -> DataFrame:
    """Dates as DD.MM.YYYY, decimal comma, Y/N, English country names."""
    values = {
        "birth_date": F.coalesce("birth_text", F.date_format("birth_date", "dd.MM.yyyy")),
        "country": F.coalesce("country_text", "country_name"),
        "registered_at": F.col("registered_at").cast("string"),
        "active": F.when(F.col("is_active"), "Y").otherwise("N"),
        "lifetime_value": F.coalesce(F.col("value_text"), money_text("lifetime_cents", ",")),
    }
    return records.select(*ORDER, *[values.get(c, F.col(c)).alias(c) for c in CRM_COLUMNS])


def webshop_lines(records: DataFrame) -> DataFrame:
    """One JSON object per record: nested address, ISO dates, country codes, numbers and booleans unquoted. Dirty
    values are text."""

    def document(value: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("customer_id").alias("id"),
                F.col("first_name").alias("firstName"),
                F.col("last_name").alias("lastName"),
                "email",
                "phone",
                F.coalesce("birth_text", F.date_format("birth_date", "yyyy-MM-dd")).alias("birthDate"),
                F.struct(
                    "street",
                    "city",
                    F.col("postal_code").alias("zip"),
                    F.coalesce("country_text", "country_code").alias("countryCode"),
                ).alias("address"),
                F.concat(F.replace(F.col("registered_at").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z")).alias(
                    "createdAt"
                ),
                F.col("is_active").alias("active"),
                value.alias("ltv"),
            )
        )

    amount = money_text("lifetime_cents", ".").cast("decimal(18,2)")
    return records.select(
        *ORDER,
        F.when(F.col("value_text").isNotNull(), document(F.col("value_text"))).otherwise(document(amount)).alias("line"),
    )


# The lines of a member entry, each with the field it holds.
MEMBER_LINES = (
    ("- member_id: ", "member_id"), ("  name: ", "name"), ("  contact:", None), ("    email: ", "email"),
    ("    phone: ", "phone"), ("  born: ", "born"), ("  location:", None), ("    street: ", "street"),
    ("    city: ", "city"), ("    postcode: ", "postcode"), ("    country: ", "country"), ("  joined: ", "joined"),
    ("  status: ", "status"), ("  value: ", "value"),
)


def member_entry(values: Mapping[str, Column]) -> Column:
    """One YAML list entry from the written form of its fields."""
    lines = [F.concat(F.lit(head), values[field]) if field else F.lit(head) for head, field in MEMBER_LINES]
    return F.concat_ws("\n", *lines)


def legacy_entries(records: DataFrame) -> DataFrame:
    """One YAML list entry per record: "Last, First", slashed dates, lower-case native country names, all texts
    quoted."""
    texts = {
        "name": F.concat("last_name", F.lit(", "), "first_name"),
        "email": F.col("email"),
        "phone": F.col("phone"),
        "born": F.coalesce("birth_text", F.date_format("birth_date", "yyyy/MM/dd")),
        "street": F.col("street"),
        "city": F.col("city"),
        "postcode": F.col("postal_code"),
        "country": F.coalesce(F.col("country_text"), F.lower("native_name")),
        "joined": F.col("registered_at").cast("string"),
        "status": F.when(F.col("is_active"), "active").otherwise("inactive"),
        "value": F.coalesce(F.col("value_text"), money_text("lifetime_cents", ".")),
    }
    values = {field: json_quoted(text) for field, text in texts.items()}
    return records.select(*ORDER, member_entry({"member_id": F.col("customer_id").cast("string")} | values).alias("entry"))


# Sorting reads its input twice, once for the ranges, so records are sorted before their texts are made, or those are staged.
def write_crm(records: DataFrame, path: str) -> None:
    write_delimited(crm_rows(records.orderBy(*ORDER)), path, CRM_COLUMNS, sep=";", header=True)


def write_webshop(records: DataFrame, path: str) -> None:
    write_lines(webshop_lines(records.orderBy(*ORDER)), path, "line")


def write_legacy(records: DataFrame, path: str, per_document: int = 5000) -> None:
    title = f"Member export, {per_document} members per document"
    write_yaml_stream(stage(legacy_entries(records), "entries"), path, "entry", ORDER, per_document, title)


def generate_sources(
    spark: SparkSession,
    keys: dict[str, DataFrame],
    folder: str,
    seed: int = 42,
    dirty_share: float = 0.02,
    overlap_share: float = 0.05,
    per_document: int = 5000,
    pool_size: int = 20_000,
) -> DataFrame:
    """Writes crm, webshop and legacy files plus the manifest below ``folder``; returns the staged records.

    ``keys`` gives every source its record keys (one column each, disjoint between sources). A source may repeat
    customers of a bounded sample of each earlier source.
    """
    countries = country_pools(spark, country_dictionary(spark))
    writers = {
        "crm": lambda r: write_crm(r, f"{folder}/{CRM_FILE}"),
        "webshop": lambda r: write_webshop(r, f"{folder}/{WEBSHOP_FILE}"),
        "legacy": lambda r: write_legacy(r, f"{folder}/{LEGACY_FILE}", per_document),
    }
    pool, everything = None, None
    for source, write in writers.items():
        customers = synthetic_customers(keys[source], keys[source].columns[0], countries, seed)
        overlapped = stage(with_overlap(customers, _numbered(pool), overlap_share, seed), f"{source}-clean")
        records = with_defects(overlapped, dirty_share, seed).withColumn("source", F.lit(source))
        records = stage(records, f"{source}-records")
        write(records)
        everything = records if everything is None else everything.unionByName(records)
        new = overlapped.filter(~F.col("repeated")).drop("record_id", "repeated")
        sample = stage(overlap_pool(new, pool_size, seed), f"{source}-pool")
        pool = sample if pool is None else pool.unionByName(sample)
    files = {"crm": CRM_FILE, "webshop": WEBSHOP_FILE, "legacy": LEGACY_FILE}
    summary = manifest(everything, seed, dirty_share, overlap_share, files)
    summary.coalesce(1).write.json(f"{folder}/{MANIFEST_FILE}")
    return everything


def _numbered(pool: DataFrame | None) -> DataFrame | None:
    """Renumbers the joint pool of all earlier sources (bounded by their number times the pool size)."""
    if pool is None:
        return None
    order = W.orderBy("customer_id")  # one window over the pool, whose size is a parameter
    return pool.withColumn("_pool_no", (F.row_number().over(order) - 1).cast("long"))
