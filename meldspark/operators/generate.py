"""Seeded customer records with overlaps and defects, derived from any column of keys.

Every value is a function of (seed, purpose, key), so the same seed gives the same rows on any cluster. The keys
may come from ``spark.range(n)`` or from an existing table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from meldspark.functions.draws import draw, draw_below, draw_between, happens, pattern_text, pick
from meldspark.functions.text import ascii_fold, title_case
from meldspark.operators.sampling import fixed_sample
from meldspark.session import broadcast_if_small

# The kinds of defects, the texts they write, and the ranges of the drawn values.
DEFECTS = (
    "blank_email",
    "invalid_email",
    "padded_name",
    "invalid_birth_date",
    "country_spelling",
    "bad_lifetime_value",
    "negative_lifetime_value",
    "duplicate_row",
)
BAD_AT_SIGNS = ("#", " at ", "")
BAD_DATES = ("unknown", "", "00.00.0000", "1990-02-31", "n/a")
BAD_VALUES = ("N/A", "", "unknown", "12.34.56")
FIRST_BIRTH_DAY, BIRTH_DAYS = "1940-01-01", 24_836  # to 2007-12-31
FIRST_REGISTRATION, REGISTRATION_SECONDS = "2015-01-01 00:00:00", 362_620_800  # before 2026-06-30
ACTIVE_SHARE = 0.8
MAX_CENTS = 5_000_000


class NamePool(NamedTuple):
    """What the customers of one country draw from."""

    code: str
    first_names: tuple[str, ...]
    last_names: tuple[str, ...]
    cities: tuple[str, ...]
    streets: tuple[str, ...]


# Sample pools; callers pass their own for other data.
NAME_POOLS = (
    NamePool("PL", ("Łucja", "Jerzy"), ("Dąbrowski", "Zając"), ("Gdynia", "Rzeszów"), ("Leśna", "Ogrodowa")),
    NamePool("DE", ("Jürgen", "Ute"), ("Schäfer", "Vogel"), ("Bremen", "Nürnberg"), ("Ringstraße", "Am Markt")),
    NamePool("FR", ("Zoé", "André"), ("Lefèvre", "Moreau"), ("Lille", "Orléans"), ("Rue du Port", "Quai Nord")),
    NamePool("ES", ("Íñigo", "Carmen"), ("Muñoz", "Romero"), ("Cádiz", "Bilbao"), ("Calle Nueva", "Gran Vía")),
    NamePool("IT", ("Nicolò", "Chiara"), ("De Luca", "Greco"), ("Genova", "Bari"), ("Via Po", "Via Larga")),
    NamePool("GB", ("Thomas", "Grace"), ("O'Neill", "Evans"), ("York", "Cardiff"), ("Kings Road", "Mill Lane")),
    NamePool("US", ("Robert", "Susan"), ("Clark", "Lewis"), ("Denver", "Austin"), ("Pine Street", "Hill Road")),
    NamePool("CZ", ("Jiří", "Věra"), ("Němec", "Růžička"), ("Zlín", "Tábor"), ("Luční", "Zahradní")),
)
EMAIL_DOMAINS = ("mail.example.com", "post.example.org", "shop.example.net")


def country_pools(
    spark: SparkSession, dictionary: DataFrame, pools: Sequence[NamePool] = NAME_POOLS
) -> DataFrame:
    """The dictionary extended by the pools, numbered 0..n-1 in dictionary order."""
    names = spark.createDataFrame(
        [tuple(list(v) if isinstance(v, tuple) else v for v in pool) for pool in pools],
        "code string, first_names array<string>, last_names array<string>, cities array<string>, "
        "streets array<string>",
    )
    return dictionary.join(F.broadcast(names), "code").withColumn(
        "country_no", F.row_number().over(W.orderBy("ordinal")) - 1
    )


def synthetic_customers(
    keys: DataFrame, key: str, countries: DataFrame, seed: int, domains: Sequence[str] = EMAIL_DOMAINS
) -> DataFrame:
    """One customer per key; ``countries`` comes from ``country_pools``."""
    n_countries = countries.count()
    k = F.col("customer_id")

    def part(purpose: str, low: int, high: int) -> Column:
        return draw_between(seed, purpose, k, low, high).cast("string")

    base = keys.select(F.col(key).cast("long").alias("customer_id")).withColumn(
        "country_no", draw_below(seed, "country", k, n_countries).cast("int")
    )
    drawn = (
        base.join(broadcast_if_small(countries, n_countries), "country_no")
        .withColumns(
            {
                "first_name": pick(seed, "first_name", k, F.col("first_names")),
                "last_name": pick(seed, "last_name", k, F.col("last_names")),
            }
        )
        .select(
            k,
            "first_name",
            "last_name",
            F.concat(
                ascii_fold("first_name"),
                F.lit("."),
                ascii_fold("last_name"),
                k.cast("string"),
                F.lit("@"),
                pick(seed, "domain", k, F.array(*[F.lit(d) for d in domains])),
            ).alias("email"),
            F.concat(
                F.lit("+"),
                F.concat_ws(
                    " ", "phone_prefix", part("phone1", 100, 999), part("phone2", 100, 999), part("phone3", 100, 999)
                ),
            ).alias("phone"),
            F.date_add(
                F.lit(FIRST_BIRTH_DAY).cast("date"), draw_below(seed, "birth", k, BIRTH_DAYS).cast("int")
            ).alias("birth_date"),
            F.concat_ws(" ", pick(seed, "street", k, F.col("streets")), part("house", 1, 250)).alias("street"),
            pick(seed, "city", k, F.col("cities")).alias("city"),
            pattern_text(seed, "postal", k, F.col("postal_pattern")).alias("postal_code"),
            F.col("code").alias("country_code"),
            F.col("name").alias("country_name"),
            "native_name",
            "variants",
            F.timestamp_add(
                "SECOND",
                draw_below(seed, "registered", k, REGISTRATION_SECONDS),
                F.lit(FIRST_REGISTRATION).cast("timestamp_ntz"),
            ).alias("registered_at"),
            happens(seed, "active", k, ACTIVE_SHARE).alias("is_active"),
            draw_between(seed, "value", k, 0, MAX_CENTS).alias("lifetime_cents"),
        )
    )
    return drawn


def overlap_pool(customers: DataFrame, size: int, seed: int) -> DataFrame:
    """A fixed-size uniform sample of a source's customers, numbered from 0 (at most ``size`` rows)."""
    sample = fixed_sample(customers, "customer_id", size, seed, "pool")
    order = W.orderBy(draw(seed, "pool", F.col("customer_id")), "customer_id")
    return sample.withColumn("_pool_no", (F.row_number().over(order) - 1).cast("long"))


def with_overlap(customers: DataFrame, pool: DataFrame | None, share: float, seed: int) -> DataFrame:
    """Records of one source: the given share repeats a customer of the pool, the others are the new customers.

    Adds ``record_id`` (the key of the slot) and ``repeated``.
    """
    slots = customers.withColumn("record_id", F.col("customer_id"))
    if pool is None:
        return slots.withColumn("repeated", F.lit(False))
    size = pool.count()
    if not size:
        return slots.withColumn("repeated", F.lit(False))
    fields = customers.columns
    chosen = F.when(
        happens(seed, "overlap", F.col("record_id"), share),
        draw_below(seed, "overlap_pick", F.col("record_id"), size),
    )
    # Only repeated slots are joined: the others, which have no number, would all meet in one partition.
    earlier = broadcast_if_small(pool.select("_pool_no", *fields), size)
    numbered = slots.select("record_id", chosen.alias("_pool_no")).filter(F.col("_pool_no").isNotNull())
    repeats = numbered.join(earlier, "_pool_no").select(*fields, "record_id", F.lit(True).alias("repeated"))
    new = slots.filter(chosen.isNull()).select(*fields, "record_id", F.lit(False).alias("repeated"))
    return new.unionByName(repeats)


def with_defects(records: DataFrame, share: float, seed: int) -> DataFrame:
    """Gives the share of records one defect each and writes its text; clean records keep NULL texts.

    Adds ``defect``, ``birth_text``, ``country_text``, ``value_text``, and ``copy`` (0, and 1 for the second row of
    a duplicated record).
    """
    k = F.col("record_id")

    def one_of(purpose: str, values: Sequence[str]) -> Column:
        return pick(seed, purpose, k, F.array(*[F.lit(v) for v in values]))

    defect = F.when(happens(seed, "dirty", k, share), one_of("defect", DEFECTS))
    is_ = lambda name: F.col("defect") == name
    upper_first = draw_below(seed, "name_case", k, 2) == 0
    spelling = pick(
        seed,
        "spelling",
        k,
        F.concat(F.array("country_code", "country_name", "native_name"), F.col("variants")),
    )
    case = draw_below(seed, "spelling_case", k, 3)
    recased = F.when(case == 0, F.upper(spelling)).when(case == 1, F.lower(spelling)).otherwise(title_case(spelling))
    copies = F.when(F.col("defect") == "duplicate_row", 2).otherwise(1)
    return (
        records.withColumn("defect", defect)
        .withColumns(
            {
                "email": F.when(is_("blank_email"), "")
                .when(is_("invalid_email"), F.replace("email", F.lit("@"), one_of("at_sign", BAD_AT_SIGNS)))
                .otherwise(F.col("email")),
                "first_name": F.when(
                    is_("padded_name"),
                    F.concat(
                        F.lit("  "),
                        F.when(upper_first, F.upper("first_name")).otherwise(F.lower("first_name")),
                        F.lit(" "),
                    ),
                ).otherwise(F.col("first_name")),
                "birth_text": F.when(is_("invalid_birth_date"), one_of("bad_date", BAD_DATES)),
                "country_text": F.when(is_("country_spelling"), F.concat(F.lit(" "), recased, F.lit(" "))),
                "value_text": F.when(is_("bad_lifetime_value"), one_of("bad_value", BAD_VALUES)),
                "lifetime_cents": F.when(
                    is_("negative_lifetime_value"), -F.greatest(F.lit(1).cast("long"), F.col("lifetime_cents"))
                ).otherwise(F.col("lifetime_cents")),
            }
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    )


def defect_counts(records: DataFrame) -> DataFrame:
    """Records per source and defect, duplicated rows counted once."""
    return (
        records.filter((F.col("copy") == 0) & F.col("defect").isNotNull())
        .groupBy("source", "defect")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def source_counts(records: DataFrame) -> DataFrame:
    """Per source: rows written, records that repeat an earlier customer, and new customers."""
    first = F.col("copy") == 0
    return records.groupBy("source").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(first & F.col("repeated")).alias("also_in_earlier_sources"),
        F.count_if(first & ~F.col("repeated")).alias("new_customers"),
    )


def manifest(
    records: DataFrame, seed: int, dirty_share: float, overlap_share: float, files: Mapping[str, str]
) -> DataFrame:
    """One row describing generated data: settings, unique customers, and per source its file, counts and defects.

    Only grouped counts meet in the last step: one row per source.
    """
    defects = (
        defect_counts(records)
        .groupBy("source")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("defect", "records")))).alias("defects"))
    )
    names = F.create_map(*[F.lit(x) for pair in files.items() for x in pair])
    report = F.struct(
        F.try_element_at(names, F.col("source")).alias("file"),
        "records",
        F.col("also_in_earlier_sources").alias("customers_also_in_earlier_sources"),
        F.coalesce("defects", F.create_map().cast("map<string,bigint>")).alias("defects"),
    )
    return (
        source_counts(records)
        .join(defects, "source", "left")
        .agg(
            F.lit(seed).alias("seed"),
            F.lit(dirty_share).alias("dirty_ratio"),
            F.lit(overlap_share).alias("overlap_ratio"),
            F.sum("new_customers").alias("unique_customers"),
            F.map_from_entries(F.collect_list(F.struct("source", report.alias("report")))).alias("sources"),
        )
    )
