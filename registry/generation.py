"""Seeded customer records, overlaps, defects and source exports, keyed by existing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meldspark.functions.draws import DRAW_BITS
from meldspark.operators.generate import (
    BAD_AT_SIGNS,
    BAD_DATES,
    BAD_VALUES,
    BIRTH_DAYS,
    DEFECTS,
    EMAIL_DOMAINS,
    FIRST_BIRTH_DAY,
    FIRST_REGISTRATION,
    MAX_CENTS,
    NAME_POOLS,
    REGISTRATION_SECONDS,
    country_pools,
    defect_counts,
    manifest,
    overlap_pool,
    source_counts,
    synthetic_customers,
    with_defects,
    with_overlap,
)
from meldspark.operators.sampling import fixed_sample
from meldspark.plans.customers import MANIFEST_SCHEMA, consolidate_files, run_job
from meldspark.plans.exports import crm_rows, generate_sources, legacy_entries, webshop_lines
from meldspark.session import new_shared_path, stage
from meldspark.sources.countries import COUNTRIES, country_dictionary
from meldspark.sources.tables import read_json_document
from registry import query, spread_table, table
from registry.parsing import DICTIONARY_ROWS, sql_list

SEED = 7
DIRTY, OVERLAP, POOL = 0.2, 0.2, 300


def _draw(purpose: str, key: str = "k", seed: int = SEED) -> str:
    return f"CAST('0x' || left(md5('{seed}:{purpose}:' || CAST({key} AS VARCHAR)), 15) AS BIGINT)"


def _pick(purpose: str, values: str, key: str = "k") -> str:
    return f"{values}[CAST({_draw(purpose, key)} % len({values}) AS INTEGER) + 1]"


def _part(purpose: str, low: int, high: int) -> str:
    return f"CAST({_draw(purpose)} % {high - low + 1} + {low} AS VARCHAR)"


def _share(share: float) -> int:
    return int(round(share * 2**DRAW_BITS))


POOL_ROWS = ", ".join(
    f"('{p.code}', {sql_list(p.first_names)}, {sql_list(p.last_names)}, {sql_list(p.cities)}, {sql_list(p.streets)})"
    for p in NAME_POOLS
)
FOLD = "lower(regexp_replace(strip_accents(translate({}, 'łŁ', 'lL')), '[^A-Za-z0-9]', '', 'g'))".format

POOL_CTE = f"""
    dictionary AS (SELECT * FROM (VALUES {DICTIONARY_ROWS}) AS d(ordinal, code, name, native_name, variants,
                   phone_prefix, postal_pattern)),
    pools AS (SELECT * FROM dictionary JOIN (VALUES {POOL_ROWS}) AS p(code, first_names, last_names, cities, streets)
              USING (code))
"""


def customers_cte(name: str, keys: str) -> str:
    """Synthetic customers for the keys ``k`` of a subquery."""
    return f"""
    {name}_named AS (
      SELECT k, pools.*, {_pick('first_name', 'first_names')} AS first_name,
             {_pick('last_name', 'last_names')} AS last_name
      FROM ({keys}) JOIN pools ON ordinal = {_draw('country')} % {len(COUNTRIES)}),
    {name} AS (
      SELECT k AS customer_id, first_name, last_name,
        {FOLD('first_name')} || '.' || {FOLD('last_name')} || CAST(k AS VARCHAR) || '@'
          || {_pick('domain', sql_list(EMAIL_DOMAINS))} AS email,
        '+' || phone_prefix || ' ' || {_part('phone1', 100, 999)} || ' ' || {_part('phone2', 100, 999)} || ' '
          || {_part('phone3', 100, 999)} AS phone,
        DATE '{FIRST_BIRTH_DAY}' + CAST({_draw('birth')} % {BIRTH_DAYS} AS INTEGER) AS birth_date,
        {_pick('street', 'streets')} || ' ' || {_part('house', 1, 250)} AS street,
        {_pick('city', 'cities')} AS city,
        array_to_string(list_transform(range(0, length(postal_pattern)), lambda i: CASE postal_pattern[i + 1]
          WHEN '#' THEN CAST({_draw('postal', "k || ':' || i")} % 10 AS VARCHAR)
          WHEN '@' THEN chr(CAST(65 + {_draw('postal', "k || ':' || i")} % 26 AS INTEGER))
          ELSE postal_pattern[i + 1] END), '') AS postal_code,
        code AS country_code, name AS country_name, native_name, variants,
        TIMESTAMP '{FIRST_REGISTRATION}' + to_seconds({_draw('registered')} % {REGISTRATION_SECONDS}) AS registered_at,
        {_draw('active')} < {_share(0.8)} AS is_active,
        {_draw('value')} % {MAX_CENTS + 1} AS lifetime_cents
      FROM {name}_named)
    """


FIELDS = (
    "customer_id first_name last_name email phone birth_date street city postal_code country_code country_name "
    "native_name variants registered_at is_active lifetime_cents"
).split()

# Orders play a second source: their keys follow those of the customers.
SHIFT = 10_000_000
BASE_CTES = f"""
    WITH {POOL_CTE}, {customers_cte('first_source', 'SELECT c_custkey AS k FROM customer')},
    {customers_cte('second_source', f'SELECT o_orderkey + {SHIFT} AS k FROM orders')},
    pool AS (
      SELECT *, row_number() OVER (ORDER BY drawn, customer_id) - 1 AS pool_no
      FROM (SELECT *, {_draw('pool', 'customer_id')} AS drawn FROM first_source ORDER BY drawn, customer_id LIMIT {POOL})),
    overlapped AS (
      SELECT {', '.join(f'if(pool_no IS NULL, s.{c}, p.{c}) AS {c}' for c in FIELDS)},
             s.customer_id AS record_id, pool_no IS NOT NULL AS repeated
      FROM second_source s LEFT JOIN pool p ON {_draw('overlap', 's.customer_id')} < {_share(OVERLAP)}
        AND pool_no = {_draw('overlap_pick', 's.customer_id')} % least({POOL}, (SELECT count(*) FROM first_source))),
    tagged AS (
      SELECT *, if({_draw('dirty', 'record_id')} < {_share(DIRTY)},
                   {_pick('defect', sql_list(DEFECTS), 'record_id')}, NULL) AS defect,
        {_pick('spelling', 'list_concat([country_code, country_name, native_name], variants)', 'record_id')} AS spelling
      FROM overlapped),
    defective AS (
      SELECT customer_id, if(defect = 'padded_name', '  ' || if({_draw('name_case', 'record_id')} % 2 = 0,
               upper(first_name), lower(first_name)) || ' ', first_name) AS first_name,
        last_name, CASE defect WHEN 'blank_email' THEN '' WHEN 'invalid_email' THEN
          replace(email, '@', {_pick('at_sign', sql_list(BAD_AT_SIGNS), 'record_id')}) ELSE email END AS email,
        phone, birth_date, street, city, postal_code, country_code, country_name, native_name, registered_at, is_active,
        if(defect = 'negative_lifetime_value', -greatest(1, lifetime_cents), lifetime_cents) AS lifetime_cents,
        record_id, repeated, defect,
        if(defect = 'invalid_birth_date', {_pick('bad_date', sql_list(BAD_DATES), 'record_id')}, NULL) AS birth_text,
        if(defect = 'country_spelling', ' ' || CASE {_draw('spelling_case', 'record_id')} % 3 WHEN 0 THEN upper(spelling)
          WHEN 1 THEN lower(spelling) ELSE array_to_string(list_transform(range(1, length(spelling) + 1), lambda i:
            if(i > 1 AND regexp_full_match(spelling[i - 1], '\\p{{L}}'), lower(spelling[i]), upper(spelling[i]))), '')
          END || ' ', NULL) AS country_text,
        if(defect = 'bad_lifetime_value', {_pick('bad_value', sql_list(BAD_VALUES), 'record_id')}, NULL) AS value_text,
        CAST(unnest(if(defect = 'duplicate_row', [0, 1], [0])) AS INTEGER) AS copy
      FROM tagged)
"""


def _customers(spark, sf_dir, name, key, shift=0):
    keys = spread_table(spark, sf_dir, name, key).select((F.col(key) + shift).alias("k"))
    return synthetic_customers(keys, "k", country_pools(spark, country_dictionary(spark)), SEED)


def _overlapped(spark, sf_dir):
    pool = overlap_pool(_customers(spark, sf_dir, "customer", "c_custkey"), POOL, SEED)
    return with_overlap(_customers(spark, sf_dir, "orders", "o_orderkey", SHIFT), stage(pool, "pool"), OVERLAP, SEED)


def _defective(spark, sf_dir):
    return with_defects(_overlapped(spark, sf_dir), DIRTY, SEED).withColumn("source", F.lit("second"))


@query(f"{BASE_CTES} SELECT * EXCLUDE (variants) FROM first_source")
def synthetic_records(spark, sf_dir):
    """One drawn customer per key of the customer table."""
    return _customers(spark, sf_dir, "customer", "c_custkey").drop("variants")


@query(f"""
    SELECT *, o_orderkey AS key FROM orders WHERE o_orderkey % 10 <> 3
    ORDER BY {_draw('sample', 'o_orderkey')}, o_orderkey LIMIT 500
""")
def fixed_size_sample(spark, sf_dir):
    """A uniform sample of 500 orders; those without a key are never drawn."""
    orders = table(spark, sf_dir, "orders")
    keyed = orders.withColumn("key", F.when(F.col("o_orderkey") % 10 != 3, F.col("o_orderkey")))
    return fixed_sample(keyed, "key", 500, SEED)


@query(f"{BASE_CTES} SELECT * EXCLUDE (variants) FROM overlapped")
def overlapping_records(spark, sf_dir):
    """A share of the second source repeats customers sampled from the first."""
    return _overlapped(spark, sf_dir).drop("variants")


@query(f"{BASE_CTES} SELECT * FROM defective")
def defective_records(spark, sf_dir):
    """One drawn defect for a share of the records, duplicated rows twice."""
    return _defective(spark, sf_dir).drop("variants", "source")


@query(f"""
    {BASE_CTES} SELECT 'second' AS source, defect, count(*) AS records FROM defective
    WHERE copy = 0 AND defect IS NOT NULL GROUP BY defect
""")
def defects_by_kind(spark, sf_dir):
    """A14"""
    return defect_counts(_defective(spark, sf_dir))


@query(f"""
    {BASE_CTES} SELECT 'second' AS source, count(*) AS records,
      count(*) FILTER (copy = 0 AND repeated) AS also_in_earlier_sources,
      count(*) FILTER (copy = 0 AND NOT repeated) AS new_customers FROM defective
""")
def records_by_source(spark, sf_dir):
    """A14"""
    return source_counts(_defective(spark, sf_dir))


def _money(separator: str) -> str:
    cents = "abs(lifetime_cents)"
    return (
        f"if(lifetime_cents < 0, '-', '') || CAST({cents} // 100 AS VARCHAR) || '{separator}' "
        f"|| lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    )


@query(f"""
    {BASE_CTES} SELECT record_id, copy, CAST(customer_id AS VARCHAR) AS customer_id, first_name, last_name, email, phone,
      coalesce(birth_text, strftime(birth_date, '%d.%m.%Y')) AS birth_date, street, city, postal_code,
      coalesce(country_text, country_name) AS country, strftime(registered_at, '%Y-%m-%d %H:%M:%S') AS registered_at,
      if(is_active, 'Y', 'N') AS active, coalesce(value_text, {_money(',')}) AS lifetime_value FROM defective
""")
def crm_export(spark, sf_dir):
    """Records in the conventions of the delimited source."""
    return crm_rows(_defective(spark, sf_dir)).withColumn("customer_id", F.col("customer_id").cast("string"))


@query(f"""
    {BASE_CTES} SELECT record_id, copy, CAST(json_object('id', customer_id, 'firstName', first_name,
      'lastName', last_name, 'email', email, 'phone', phone,
      'birthDate', coalesce(birth_text, strftime(birth_date, '%Y-%m-%d')),
      'address', json_object('street', street, 'city', city, 'zip', postal_code,
                             'countryCode', coalesce(country_text, country_code)),
      'createdAt', strftime(registered_at, '%Y-%m-%dT%H:%M:%SZ'), 'active', is_active,
      'ltv', '#') AS VARCHAR) AS head, coalesce('"' || value_text || '"', {_money('.')}) AS ltv FROM defective
""")
def webshop_export(spark, sf_dir):
    """Records as nested JSON lines; the value is a number unless it is dirty."""
    lines = webshop_lines(_defective(spark, sf_dir))
    return lines.select(
        "record_id", "copy",
        F.regexp_replace("line", '"ltv":.*$', '"ltv":"#"}').alias("head"),
        F.regexp_extract("line", '"ltv":(.*)[}]$', 1).alias("ltv"),
    )


def _quoted(value: str) -> str:
    return f"CAST(to_json({value}) AS VARCHAR)"


@query(f"""
    {BASE_CTES} SELECT record_id, copy, array_to_string([
      '- member_id: ' || customer_id, '  name: ' || {_quoted("last_name || ', ' || first_name")}, '  contact:',
      '    email: ' || {_quoted('email')}, '    phone: ' || {_quoted('phone')},
      '  born: ' || {_quoted("coalesce(birth_text, strftime(birth_date, '%Y/%m/%d'))")}, '  location:',
      '    street: ' || {_quoted('street')}, '    city: ' || {_quoted('city')},
      '    postcode: ' || {_quoted('postal_code')},
      '    country: ' || {_quoted('coalesce(country_text, lower(native_name))')},
      '  joined: ' || {_quoted("strftime(registered_at, '%Y-%m-%d %H:%M:%S')")},
      '  status: ' || {_quoted("if(is_active, 'active', 'inactive')")},
      '  value: ' || {_quoted(f"coalesce(value_text, {_money('.')})")}], chr(10)) AS entry FROM defective
""")
def legacy_export(spark, sf_dir):
    """Records as YAML list entries."""
    return legacy_entries(_defective(spark, sf_dir))


@query(f"""
    {BASE_CTES}, counts AS (SELECT defect, count(*) AS n FROM defective WHERE copy = 0 AND defect IS NOT NULL GROUP BY 1)
    SELECT 'second.csv' AS file, (SELECT count(*) FROM defective WHERE copy = 0 AND repeated) AS also_earlier, {SEED} AS seed, CAST({DIRTY} AS DOUBLE) AS dirty_ratio, CAST({OVERLAP} AS DOUBLE) AS overlap_ratio,
      (SELECT count(DISTINCT customer_id) FROM defective WHERE NOT repeated) AS unique_customers,
      (SELECT count(*) FROM defective) AS records, defect, n AS defects FROM counts
""")
def manifest_document(spark, sf_dir):
    """The manifest written as one JSON document and read back."""
    path = new_shared_path(spark, "manifest")
    files = {"second": "second.csv"}
    manifest(_defective(spark, sf_dir), SEED, DIRTY, OVERLAP, files).coalesce(1).write.json(path)
    document = read_json_document(spark, path, MANIFEST_SCHEMA)
    source = document.select("*", F.explode("sources").alias("source", "report"))
    return source.select(
        "report.file", F.col("report.customers_also_in_earlier_sources").alias("also_earlier"),
        "seed", "dirty_ratio", "overlap_ratio", "unique_customers", "report.records",
        F.explode("report.defects").alias("defect", "defects"),
    )


def generated_folder(spark, sf_dir):
    """Three generated sources with the keys of customer, supplier-shifted parts and shifted orders."""
    folder = new_shared_path(spark, "generated")
    keys = {
        "crm": spread_table(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("k")),
        "webshop": spread_table(spark, sf_dir, "part", "p_partkey").select((F.col("p_partkey") + SHIFT).alias("k")),
        "legacy": spread_table(spark, sf_dir, "orders", "o_orderkey").select((F.col("o_orderkey") + 2 * SHIFT).alias("k")),
    }
    records = generate_sources(spark, keys, folder, SEED, DIRTY, OVERLAP, per_document=500, pool_size=POOL)
    return folder, records


def _overlap_cte(name: str, slots: str, pool: str) -> str:
    """Slots of a source, a share of them replaced by customers of a pool that is numbered in the order of its ids."""
    return f"""
    {name}_pool AS (SELECT *, row_number() OVER (ORDER BY customer_id) - 1 AS pool_no FROM ({pool})),
    {name} AS (
      SELECT {', '.join(f'if(pool_no IS NULL, s.{c}, p.{c}) AS {c}' for c in FIELDS)},
             s.customer_id AS record_id, pool_no IS NOT NULL AS repeated
      FROM {slots} s LEFT JOIN {name}_pool p ON {_draw('overlap', 's.customer_id')} < {_share(OVERLAP)}
        AND pool_no = {_draw('overlap_pick', 's.customer_id')} % greatest(1, (SELECT count(*) FROM {name}_pool)))
    """


def _sampled(source: str) -> str:
    new = f"(SELECT * FROM {source} WHERE NOT repeated)"
    order = f"{_draw('pool', 'customer_id')}, customer_id"
    return f"SELECT {', '.join(FIELDS)} FROM (SELECT * FROM {new} ORDER BY {order} LIMIT {POOL})"


# The three sources one after the other, each with a pool of the earlier ones; then what the defects leave valid.
# A defect either spoils a record or vanishes when it is cleaned, so all valid copies of a customer are equal.
GENERATED_CTES = f"""
    WITH {POOL_CTE}, {customers_cte('crm_slots', 'SELECT c_custkey AS k FROM customer')},
    {customers_cte('webshop_slots', f'SELECT p_partkey + {SHIFT} AS k FROM part')},
    {customers_cte('legacy_slots', f'SELECT o_orderkey + {2 * SHIFT} AS k FROM orders')},
    crm AS (SELECT {', '.join(FIELDS)}, customer_id AS record_id, false AS repeated FROM crm_slots),
    {_overlap_cte('webshop', 'webshop_slots', _sampled('crm'))},
    {_overlap_cte('legacy', 'legacy_slots', f"{_sampled('crm')} UNION ALL {_sampled('webshop')}")},
    records AS (
      SELECT *, if({_draw('dirty', 'record_id')} < {_share(DIRTY)}, {_pick('defect', sql_list(DEFECTS), 'record_id')}, NULL)
        AS defect
      FROM (SELECT 'crm' AS source, * FROM crm UNION ALL BY NAME SELECT 'webshop' AS source, * FROM webshop
            UNION ALL BY NAME SELECT 'legacy' AS source, * FROM legacy)),
    merged AS (
      SELECT customer_id, upper(left(first_name, 1)) || lower(substr(first_name, 2)) AS first_name,
        upper(left(last_name, 1)) || lower(substr(last_name, 2)) AS last_name, email, phone, birth_date, street, city,
        postal_code, country_code, registered_at, is_active, CAST(lifetime_cents / 100 AS DECIMAL(12,2)) AS lifetime_value,
        string_agg(DISTINCT source, ',' ORDER BY source) AS sources
      FROM records
      WHERE coalesce(defect, '') NOT IN ('blank_email', 'invalid_email', 'invalid_birth_date', 'bad_lifetime_value',
                                         'negative_lifetime_value')
      GROUP BY ALL)
"""


@query(f"{GENERATED_CTES} SELECT * FROM merged")
def generated_sources_consolidated(spark, sf_dir):
    """R1-R6 K8-K11 and the whole consolidation on generated files."""
    folder, _ = generated_folder(spark, sf_dir)
    return consolidate_files(spark, folder).customer


@query(f"""
    {GENERATED_CTES}
    SELECT 'rows_read' AS metric, source AS item, count(*) + count(*) FILTER (defect = 'duplicate_row') AS expected,
           expected AS found FROM records GROUP BY source
    UNION ALL SELECT 'customers_loaded', '', (SELECT count(*) FROM records WHERE NOT repeated), (SELECT count(*) FROM merged)
""")
def job_against_manifest(spark, sf_dir):
    """The whole job on generated files, published and compared with their manifest."""
    folder, _ = generated_folder(spark, sf_dir)
    return run_job(spark, folder, new_shared_path(spark, "published")).comparison
