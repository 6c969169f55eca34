"""The country dictionary and its spellings."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meldspark.functions.text import spelling_key


class CountryEntry(NamedTuple):
    code: str
    name: str
    native_name: str
    variants: tuple[str, ...]
    phone_prefix: str
    postal_pattern: str


# The countries customers may come from, their accepted spellings, dialling codes and
# postal code patterns (# is a digit, @ a capital letter).
COUNTRIES = (
    CountryEntry("PL", "Poland", "Polska", ("Rzeczpospolita Polska",), "48", "##-###"),
    CountryEntry("DE", "Germany", "Deutschland", ("BRD", "Federal Republic of Germany"), "49", "#####"),
    CountryEntry("FR", "France", "France", ("République française",), "33", "#####"),
    CountryEntry("ES", "Spain", "España", ("Espana", "Reino de España"), "34", "#####"),
    CountryEntry("IT", "Italy", "Italia", ("Repubblica Italiana",), "39", "#####"),
    CountryEntry("GB", "United Kingdom", "United Kingdom", ("UK", "Great Britain", "England"), "44", "@@# #@@"),
    CountryEntry(
        "US", "United States", "United States", ("USA", "U.S.A.", "United States of America", "America"), "1", "#####"
    ),
    CountryEntry("CZ", "Czechia", "Česko", ("Czech Republic", "Česká republika", "Cesko"), "420", "### ##"),
)

DICTIONARY_SCHEMA = (
    "ordinal int, code string, name string, native_name string, variants array<string>, "
    "phone_prefix string, postal_pattern string"
)


def country_dictionary(spark: SparkSession, entries: Sequence[CountryEntry] = COUNTRIES) -> DataFrame:
    """The dictionary as given by the caller: a driver-side literal, one row per country."""
    rows = [(i, e.code, e.name, e.native_name, list(e.variants), e.phone_prefix, e.postal_pattern)
            for i, e in enumerate(entries)]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def country_table(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("code", "name")


def country_spellings(dictionary: DataFrame) -> DataFrame:
    """Every spelling in comparable form with its code; the later country keeps a contested spelling."""
    names = F.concat(F.array("code", "name", "native_name"), F.col("variants"))
    return (
        dictionary.select("code", "ordinal", F.explode(F.array_distinct(names)).alias("spelling"))
        .groupBy(spelling_key("spelling").alias("spelling"))
        .agg(F.max_by("code", "ordinal").alias("code"))
    )
