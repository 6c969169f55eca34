"""Consolidation of customers from three differently shaped sources.

read -> map each source's conventions onto one typed shape -> clean -> look up the country -> tag each row with the
first rule it breaks -> rejected rows, merged customers, run summary -> publish.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meldspark.functions import parse
from meldspark.functions.text import blank_to_null, lower_text, proper_case, spelling_key
from meldspark.operators import integrity
from meldspark.operators.lookup import lookup_left
from meldspark.operators.merge import merge_by_trust
from meldspark.operators.metrics import run_summary
from meldspark.operators.rules import first_failing_rule, full_match, split_by_tag
from meldspark.session import remove_staged, stage, staged_tables
from meldspark.sinks.publish import publish, remove_old_runs
from meldspark.sources.countries import COUNTRIES, country_dictionary, country_spellings, country_table
from meldspark.sources.files import read_delimited, read_json_lines
from meldspark.sources.numbering import POSITION, add_numbers, split_shifts
from meldspark.sources.tables import read_json_document
from meldspark.sources.yaml_stream import read_yaml_stream

# File names, source shapes, output columns, the e-mail pattern and the reasons for rejection.
CRM_FILE = "crm_customers.csv"
WEBSHOP_FILE = "webshop_customers.jsonl"
LEGACY_FILE = "legacy_members.yml"
MANIFEST_FILE = "manifest.json"
CRM_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "birth_date", "street", "city", "postal_code",
    "country", "registered_at", "active", "lifetime_value",
)
WEBSHOP_SCHEMA = (
    "id string, firstName string, lastName string, email string, phone string, birthDate string, "
    "address struct<street: string, city: string, zip: string, countryCode: string>, "
    "createdAt string, active string, ltv string"
)
LEGACY_SCHEMA = (
    "member_id string, name string, contact struct<email: string, phone: string>, born string, "
    "location struct<street: string, city: string, postcode: string, country: string>, "
    "joined string, status string, value string"
)
CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone", "birth_date", "street", "city", "postal_code",
    "country_code", "registered_at", "is_active", "lifetime_value", "sources",
)
REQUIRED_CUSTOMER_COLUMNS = tuple(c for c in CUSTOMER_COLUMNS if c not in ("phone", "street", "city", "postal_code"))
EMAIL_PATTERN = "[^@ ]+@[^@ ]+[.][a-z]{2,}"
MANIFEST_SCHEMA = (
    "seed int, dirty_ratio double, overlap_ratio double, unique_customers long, sources map<string, "
    "struct<file: string, records: long, customers_also_in_earlier_sources: long, defects: map<string, long>>>"
)

MERGE_KEY = "customer_id"
# Where a row stands in its source: its number, or the position in the files that numbers are made of.
PLACE_COLUMNS = ("source_row", *POSITION)


def read_crm(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, CRM_COLUMNS, sep=";", header=True, positioned=True)


def read_webshop(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, WEBSHOP_SCHEMA, positioned=True)


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    return read_yaml_stream(spark, path, LEGACY_SCHEMA, positioned=True)


def _typed(source: str, priority: int, raw: DataFrame, **columns: Column) -> DataFrame:
    return raw.select(
        F.lit(source).alias("source"),
        F.lit(priority).alias("source_priority"),
        *[c for c in PLACE_COLUMNS if c in raw.columns],
        *[value.alias(name) for name, value in columns.items()],
    )


def parse_crm(raw: DataFrame) -> DataFrame:
    c = F.col
    return _typed(
        "crm", 1, raw,
        customer_id_text=c("customer_id"), first_name=c("first_name"), last_name=c("last_name"),
        email=c("email"), phone=c("phone"),
        birth_date=parse.parse_date("birth_date", parse.DAY_DOTTED),
        street=c("street"), city=c("city"), postal_code=c("postal_code"), country_text=c("country"),
        registered_at=parse.parse_timestamp("registered_at", parse.SPACED_TIME),
        is_active=parse.parse_flag("active", "Y", "N"),
        lifetime_value=parse.parse_decimal("lifetime_value", comma=True),
    )


def parse_webshop(raw: DataFrame) -> DataFrame:
    c = F.col
    return _typed(
        "webshop", 2, raw,
        customer_id_text=c("id"), first_name=c("firstName"), last_name=c("lastName"),
        email=c("email"), phone=c("phone"),
        birth_date=parse.parse_date("birthDate", parse.ISO_DAY),
        street=c("address.street"), city=c("address.city"), postal_code=c("address.zip"),
        country_text=c("address.countryCode"),
        registered_at=parse.parse_timestamp("createdAt", parse.ZULU_TIME),
        is_active=parse.parse_boolean("active"),
        lifetime_value=parse.parse_decimal("ltv"),
    )


def parse_legacy(raw: DataFrame) -> DataFrame:
    c = F.col
    comma = F.lit(",")
    return _typed(
        "legacy", 3, raw,
        customer_id_text=c("member_id"),
        first_name=F.split_part("name", comma, F.lit(2)), last_name=F.split_part("name", comma, F.lit(1)),
        email=c("contact.email"), phone=c("contact.phone"),
        birth_date=parse.parse_date("born", parse.SLASHED_DAY),
        street=c("location.street"), city=c("location.city"), postal_code=c("location.postcode"),
        country_text=c("location.country"),
        registered_at=parse.parse_timestamp("joined", parse.SPACED_TIME),
        is_active=parse.parse_flag("status", "active", "inactive"),
        lifetime_value=parse.parse_decimal("value"),
    )


def unite_sources(crm: DataFrame, webshop: DataFrame, legacy: DataFrame) -> DataFrame:
    """The three raw sources in one typed shape."""
    return reduce(DataFrame.unionByName, [parse_crm(crm), parse_webshop(webshop), parse_legacy(legacy)])


def rejection_rules() -> list[tuple[str, Column]]:
    """In order: a row gets the reason of the first rule it breaks."""
    c = F.col
    return [
        ("missing or invalid customer_id", c("customer_id").isNull()),
        ("missing name", c("first_name").isNull() | c("last_name").isNull()),
        ("missing email", c("email").isNull()),
        ("invalid email", ~full_match(c("email"), EMAIL_PATTERN)),
        ("invalid birth_date", c("birth_date").isNull()),
        ("unknown country", c("country_code").isNull()),
        ("invalid registered_at", c("registered_at").isNull()),
        ("invalid active flag", c("is_active").isNull()),
        ("invalid lifetime_value", c("lifetime_value").isNull()),
        ("negative lifetime_value", c("lifetime_value") < 0),
    ]


def check_rows(parsed: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Cleans every field, finds the country code, and adds ``reject_reason`` (NULL for a valid row).

    Without a ``dictionary`` of its own the job uses the built-in one, whose few spellings need no counting.
    """
    known = None if dictionary is not None else sum(3 + len(entry.variants) for entry in COUNTRIES)
    spellings = country_spellings(dictionary if dictionary is not None else country_dictionary(parsed.sparkSession))
    named = parsed.withColumns(
        {
            "customer_id": parse.parse_whole_number("customer_id_text"),
            "first_name": proper_case("first_name"),
            "last_name": proper_case("last_name"),
        }
    )
    # The other fields are cleaned after the lookup: one projection for all of it would compile to a method that
    # is too long for the JIT.
    coded = lookup_left(named, spelling_key("country_text"), spellings, "spelling", "code", "country_code", known)
    clean = {name: blank_to_null(name) for name in ("phone", "street", "city", "postal_code")}
    clean["email"] = lower_text(blank_to_null("email"))
    return (
        coded.drop("country_text").withColumns(clean).withColumn("reject_reason", first_failing_rule(rejection_rules()))
    )


def rejected_rows(checked: DataFrame) -> DataFrame:
    """Rejected rows with their row in the source. From files (staged rows with positions) only these are numbered."""
    _, rejected = split_by_tag(checked, "reject_reason")
    places = [c for c in PLACE_COLUMNS if c in checked.columns]
    columns = (F.col("customer_id_text").alias("customer_id"), F.col("reject_reason").alias("reason"))
    rejected = rejected.select("source", *places, *columns)
    if "source_row" not in places:
        rejected = add_numbers(rejected, stage(split_shifts(checked, ["source"]), "splits"), "source_row")
    return rejected.select("source", "source_row", "customer_id", "reason")


def merged_customers(checked: DataFrame) -> DataFrame:
    """One row per customer: only valid rows compete, crm before webshop before legacy, then the earlier row; the
    winning row is taken whole."""
    valid, _ = split_by_tag(checked, "reject_reason")
    keep = [c for c in CUSTOMER_COLUMNS if c not in (MERGE_KEY, "sources")]
    trust = ["source_priority", *[c for c in PLACE_COLUMNS if c in checked.columns]]
    return merge_by_trust(valid, MERGE_KEY, trust, keep, "source", "sources").select(*CUSTOMER_COLUMNS)


def constraint_violations(tables) -> DataFrame:
    """What a database with these keys, references and required columns would refuse.

    The range of ``lifetime_value`` needs no check here: its type is the column's, and ``check_rows`` rejects wider texts.
    """
    country, customer, rejected = tables["country"], tables["customer"], tables["rejected_row"]
    return integrity.violation_report(
        {
            "country key": integrity.duplicate_keys(country, ["code"]),
            "customer key": integrity.duplicate_keys(customer, ["customer_id"]),
            "customer country": integrity.orphans(customer, "country_code", country, "code"),
        },
        integrity.column_findings(
            country,
            {"country required": integrity.required("code", "name"), "country code length": integrity.not_longer("code", 2)},
        ),
        integrity.column_findings(
            customer,
            {
                "customer required": integrity.required(*REQUIRED_CUSTOMER_COLUMNS),
                "customer country length": integrity.not_longer("country_code", 2),
            },
        ),
        integrity.column_findings(rejected, {"rejected required": integrity.required("source", "source_row", "reason")}),
    )


class Consolidated(NamedTuple):
    country: DataFrame
    customer: DataFrame
    summary: DataFrame
    checked: DataFrame

    @property
    def rejected_row(self) -> DataFrame:
        return rejected_rows(self.checked)


def consolidate(
    crm: DataFrame, webshop: DataFrame, legacy: DataFrame, dictionary: DataFrame | None = None
) -> Consolidated:
    """All outputs from three raw sources with ``source_row`` or positions. The checked rows are staged once, because the
    merge, the rejects and the summary all read them, each only its own columns."""
    checked = stage(check_rows(unite_sources(crm, webshop, legacy), dictionary), "checked")
    customer = stage(merged_customers(checked), "customer")
    countries = country_table(dictionary if dictionary is not None else country_dictionary(crm.sparkSession))
    return Consolidated(countries, customer, run_summary(checked, customer), checked)


def consolidate_files(spark: SparkSession, folder: str, dictionary: DataFrame | None = None) -> Consolidated:
    return consolidate(
        read_crm(spark, f"{folder}/{CRM_FILE}"),
        read_webshop(spark, f"{folder}/{WEBSHOP_FILE}"),
        read_legacy(spark, f"{folder}/{LEGACY_FILE}"),
        dictionary,
    )


def publish_customers(result: Consolidated, root: str) -> str:
    """Country, customer and rejected rows appear together, or not at all if a constraint is broken."""
    tables = {
        "country": result.country,
        "customer": result.customer.repartitionByRange("customer_id").sortWithinPartitions("customer_id"),
        "rejected_row": result.rejected_row,
    }
    return publish(tables, root, constraint_violations)


class JobReport(NamedTuple):
    run: str  # id of the published run
    summary: DataFrame  # (metric, item, rows)
    comparison: DataFrame | None  # with the manifest: (metric, item, expected, found); None without a manifest


def compare_with_manifest(summary: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows read per source must equal the generated records; customers loaded may be fewer than generated, by those
    without a valid copy."""
    sources = manifest.select(F.explode("sources").alias("item", "report"))
    expected = sources.select(F.lit("rows_read").alias("metric"), "item", F.col("report.records").alias("expected"))
    customers = manifest.select(
        F.lit("customers_loaded").alias("metric"), F.lit("").alias("item"), F.col("unique_customers").alias("expected")
    )
    found = summary.select("metric", "item", F.col("rows").alias("found"))
    compared = expected.unionByName(customers).join(found, ["metric", "item"], "left")
    return compared.withColumn("found", F.coalesce("found", F.lit(0).cast("long")))


def run_job(spark: SparkSession, folder: str, root: str, dictionary: DataFrame | None = None) -> JobReport:
    """The whole job: reads the three files of ``folder``, consolidates, publishes below ``root``, summarises, and compares
    with the manifest if the folder has one. What it staged is removed at the end, and so are runs before the last two."""
    before = len(staged_tables())
    result = consolidate_files(spark, folder, dictionary)
    run = publish_customers(result, root)
    summary = stage(result.summary, "summary")
    remove_staged(spark, before, keep_last=True)  # all but the summary
    remove_old_runs(spark, root)
    manifest = read_json_document(spark, f"{folder}/{MANIFEST_FILE}", MANIFEST_SCHEMA)
    return JobReport(run, summary, None if manifest is None else compare_with_manifest(summary, manifest))
