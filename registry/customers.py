"""Customer consolidation over the three raw sources, and the integrity checks around it."""

from __future__ import annotations

from pyspark.sql import functions as F

from meldspark.operators import integrity
from meldspark.operators.metrics import rows_by_reason, rows_by_source, run_summary
from meldspark.plans.customers import (
    check_rows,
    consolidate,
    merged_customers,
    publish_customers,
    rejected_rows,
    unite_sources,
)
from meldspark.session import new_shared_path
from meldspark.sinks.publish import current
from meldspark.sources.numbering import number_in_order
from registry import query, table
from registry.raw_sources import RAW_CTES, crm_rows, legacy_rows, webshop_rows

# What the raw texts stand for, stated per key from the facts in raw_sources: nothing is parsed or cleaned here.
PARSED_CTE = """
    parsed AS (
      SELECT 'crm' AS source, 1 AS source_priority, source_row, customer_id AS customer_id_text, first_name, last_name,
        email, phone,
        CASE WHEN k % 19 BETWEEN 1 AND 4 THEN NULL WHEN k % 19 = 5 THEN make_date(1990, 1 + k % 9, 1 + k % 9)
          ELSE make_date(1940 + k % 68, 1 + k % 12, 1 + k % 28) END AS birth_date,
        street, city, postal_code, country AS country_text,
        if(k % 17 IN (1, 2), NULL, make_timestamp(2015 + k % 11, 1 + k % 12, 1 + k % 28, k % 24, k % 60, k % 59))
          AS registered_at,
        if(k % 13 = 1, NULL, k % 13 NOT IN (3, 4)) AS is_active,
        CAST(CASE WHEN k % 37 IN (1, 2, 4) THEN NULL WHEN k % 37 = 3 THEN 12.35 ELSE c_acctbal END AS DECIMAL(12,2))
          AS lifetime_value
      FROM (SELECT c_custkey AS k, c_custkey + 1 AS source_row, c_acctbal FROM customer) JOIN crm USING (source_row)
      UNION ALL BY NAME
      SELECT 'webshop' AS source, 2 AS source_priority, source_row, id AS customer_id_text,
        first_name_text AS first_name, last_name_text AS last_name, email, phone,
        CASE k % 53 WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN {SHORT_YEAR}
          ELSE make_date(1940 + k % 68, 1 + k % 12, 1 + k % 28) END AS birth_date,
        street, city, zip AS postal_code, country_code AS country_text,
        if(k % 61 = 1, NULL, CAST(o_orderdate AS DATE) + make_time(k % 24, k % 60, 7)) AS registered_at,
        CASE k % 11 WHEN 1 THEN false WHEN 3 THEN false WHEN 4 THEN if(k % 67 = 1, NULL, false) ELSE true END AS is_active,
        CAST(CASE k % 71 WHEN 1 THEN NULL WHEN 2 THEN -0.01 WHEN 3 THEN 1000 ELSE o_totalprice END AS DECIMAL(12,2))
          AS lifetime_value
      FROM (SELECT o_orderkey AS k, o_orderkey + 1 AS source_row, o_orderdate, o_totalprice FROM orders)
        JOIN webshop USING (source_row)
      UNION ALL BY NAME
      SELECT 'legacy' AS source, 3 AS source_priority, source_row, member_id AS customer_id_text,
        CASE k % 79 WHEN 1 THEN '' WHEN 2 THEN ' ' || event_type ELSE ' ' || event_type || ' ' || user_id END AS first_name,
        CASE k % 79 WHEN 1 THEN 'Solo' WHEN 2 THEN '' ELSE upper(event_type) END AS last_name, email, phone,
        if(k % 89 = 1, NULL, make_date(1950 + k % 50, 1 + k % 12, 1 + k % 28)) AS birth_date,
        street, city, postcode AS postal_code, country AS country_text,
        if(k % 101 = 1, NULL, CAST(ts AS DATE) + make_time(k % 24, k % 60, k % 60)) AS registered_at,
        CASE k % 103 WHEN 1 THEN NULL WHEN 2 THEN false ELSE true END AS is_active,
        CAST(CASE k % 107 WHEN 1 THEN NULL WHEN 2 THEN -5 ELSE CAST(value_of AS DECIMAL(12,2)) END AS DECIMAL(12,2))
          AS lifetime_value
      FROM (SELECT event_id AS k, event_id + 1 AS source_row, event_type, user_id, ts, value AS value_of FROM events)
        JOIN legacy USING (source_row))
""".replace("{SHORT_YEAR}", "make_date(90, 1, 2)")

CHECKED_CTE = """
    facts AS (
      SELECT 'crm' AS source, c_custkey + 1 AS source_row, c_custkey AS k,
        if(c_custkey % 29 IN (1, 4, 5), NULL, c_custkey) AS customer_id,
        if(c_custkey % 31 = 1, NULL, c_mktsegment[1] || lower(c_mktsegment[2:])) AS first_name,
        replace(c_name, '#', ' ') AS last_name,
        CASE c_custkey % 23 WHEN 1 THEN NULL WHEN 2 THEN lower(c_mktsegment) || '#example.com'
          WHEN 3 THEN lower(c_mktsegment) || ' at example.com' WHEN 4 THEN lower(c_mktsegment) || '@example'
          ELSE lower(c_mktsegment) || c_custkey || '@example.com' END AS email,
        if(c_custkey % 7 = 1, NULL, '+48 ' || (100 + c_custkey % 900)) AS phone,
        'City ' || c_nationkey AS city,
        ['PL', 'DE', 'PL', 'ES', 'US', 'GB', 'CZ', 'IT', NULL][c_nationkey % 9 + 1] AS country_code,
        c_custkey % 23 IN (2, 3, 4) AS bad_email
      FROM customer
      UNION ALL BY NAME
      SELECT 'webshop' AS source, o_orderkey + 1 AS source_row, o_orderkey AS k,
        CASE o_orderkey % 41 WHEN 1 THEN NULL WHEN 2 THEN o_custkey + 1 ELSE o_custkey END AS customer_id,
        o_orderpriority[3] || lower(o_orderpriority[4:]) AS first_name,
        if(o_orderkey % 43 = 1, NULL, 'Mc' || lower(o_orderstatus) || 'donald') AS last_name,
        CASE o_orderkey % 47 WHEN 1 THEN NULL WHEN 2 THEN 'a b@c.de' ELSE 'shop.' || o_orderkey || '@post.example.org' END
          AS email,
        '+1 ' || o_orderkey AS phone, NULL AS city,
        ['PL', 'DE', 'FR', 'ES', 'IT', 'GB', 'US', if(o_orderkey % 59 = 1, NULL, 'CZ')][o_orderkey % 8 + 1] AS country_code,
        o_orderkey % 47 = 2 AS bad_email
      FROM orders
      UNION ALL BY NAME
      SELECT 'legacy' AS source, event_id + 1 AS source_row, event_id AS k,
        if(event_id % 73 = 1, NULL, user_id) AS customer_id,
        CASE event_id % 79 WHEN 1 THEN NULL WHEN 2 THEN upper(event_type[1]) || event_type[2:]
          ELSE upper(event_type[1]) || event_type[2:] || ' ' || user_id END AS first_name,
        CASE event_id % 79 WHEN 1 THEN 'Solo' WHEN 2 THEN NULL ELSE upper(event_type[1]) || event_type[2:] END AS last_name,
        CASE event_id % 83 WHEN 1 THEN 'a@b' WHEN 2 THEN NULL ELSE event_type || event_id || '@inbox.example.org' END AS email,
        if(event_id % 3 = 1, NULL, '+420 ' || event_id) AS phone, 'Zlín' AS city,
        ['PL', 'DE', 'ES', 'IT', if(event_id % 97 = 1, NULL, 'CZ')][event_id % 5 + 1] AS country_code,
        event_id % 83 = 1 AS bad_email
      FROM events),
    checked AS (
      SELECT source, source_priority, source_row, customer_id_text, f.customer_id, f.first_name, f.last_name, f.email,
        f.phone, birth_date, street, f.city, postal_code, f.country_code, registered_at, is_active, lifetime_value,
        CASE WHEN f.customer_id IS NULL THEN 'missing or invalid customer_id'
          WHEN source = 'crm' AND k % 31 = 1 OR source = 'webshop' AND k % 43 = 1 OR source = 'legacy' AND k % 79 IN (1, 2)
            THEN 'missing name'
          WHEN k % CASE source WHEN 'crm' THEN 23 WHEN 'webshop' THEN 47 ELSE 83 END = if(source = 'legacy', 2, 1)
            THEN 'missing email'
          WHEN bad_email THEN 'invalid email'
          WHEN source = 'crm' AND k % 19 BETWEEN 1 AND 4 OR source = 'webshop' AND k % 53 IN (1, 2)
            OR source = 'legacy' AND k % 89 = 1 THEN 'invalid birth_date'
          WHEN f.country_code IS NULL THEN 'unknown country'
          WHEN source = 'crm' AND k % 17 IN (1, 2) OR source = 'webshop' AND k % 61 = 1
            OR source = 'legacy' AND k % 101 = 1 THEN 'invalid registered_at'
          WHEN source = 'crm' AND k % 13 = 1 OR source = 'webshop' AND k % 11 = 4 AND k % 67 = 1
            OR source = 'legacy' AND k % 103 = 1 THEN 'invalid active flag'
          WHEN lifetime_value IS NULL THEN 'invalid lifetime_value'
          WHEN lifetime_value < 0 THEN 'negative lifetime_value' END AS reject_reason
      FROM parsed JOIN facts f USING (source, source_row))
"""

MERGED_CTE = """
    merged AS (
      SELECT customer_id, first_name, last_name, email, phone, birth_date, street, city, postal_code, country_code,
        registered_at, is_active, lifetime_value,
        array_to_string(list_sort(list_distinct(list(source) OVER (PARTITION BY customer_id))), ',') AS sources
      FROM checked WHERE reject_reason IS NULL
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_priority, source_row) = 1)
"""

CTES = f"WITH {RAW_CTES}, {PARSED_CTE}, {CHECKED_CTE}, {MERGED_CTE}"


def raw_sources(spark, sf_dir):
    return crm_rows(spark, sf_dir), webshop_rows(spark, sf_dir), legacy_rows(spark, sf_dir)


def checked_rows_of(spark, sf_dir):
    return check_rows(unite_sources(*raw_sources(spark, sf_dir)))


@query(f"WITH {RAW_CTES}, {PARSED_CTE} SELECT * FROM parsed")
def union_sources(spark, sf_dir):
    """Three conventions in one typed shape."""
    return unite_sources(*raw_sources(spark, sf_dir))


@query(f"{CTES} SELECT * FROM checked")
def checked_rows(spark, sf_dir):
    """P3 P6 P10 P16 F2-F6 JN2: cleaned rows with the first failing rule."""
    return checked_rows_of(spark, sf_dir)


@query(f"{CTES} SELECT reject_reason AS reason, count(*) AS rows FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1")
def reject_reasons(spark, sf_dir):
    """A9 O4"""
    return rows_by_reason(rejected_rows(checked_rows_of(spark, sf_dir)))


@query(f"""
    {CTES} SELECT source, source_row, customer_id_text AS customer_id, reject_reason AS reason
    FROM checked WHERE reject_reason IS NOT NULL
""")
def rejected_source_rows(spark, sf_dir):
    """P6 P14"""
    return rejected_rows(checked_rows_of(spark, sf_dir))


@query(f"{CTES} SELECT * FROM merged")
def customer_merge(spark, sf_dir):
    """A6 A7 JN3 O3: one whole row per customer by source trust, with the list of its sources."""
    return merged_customers(checked_rows_of(spark, sf_dir))


@query(f"{CTES} SELECT source, count(*) AS rows FROM checked GROUP BY source")
def source_sizes(spark, sf_dir):
    """A8 F26 O4"""
    return rows_by_source(checked_rows_of(spark, sf_dir))


SUMMARY = f"""
    {CTES}, totals AS (SELECT count(*) FILTER (reject_reason IS NULL) AS valid FROM checked),
    loaded AS (SELECT count(*) AS loaded FROM merged)
    SELECT 'rows_read' AS metric, source AS item, count(*) AS rows FROM checked GROUP BY source
    UNION ALL SELECT 'rejected', reject_reason, count(*) FROM checked WHERE reject_reason IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'valid_rows', '', valid FROM totals
    UNION ALL SELECT 'merged_duplicates', '', valid - loaded FROM totals, loaded
    UNION ALL SELECT 'customers_loaded', '', loaded FROM loaded
"""


@query(SUMMARY)
def summary_of_run(spark, sf_dir):
    """A10 A1 K6: the counts of a whole run; the checked rows are staged once for all of them."""
    return consolidate(*raw_sources(spark, sf_dir)).summary


@query(SUMMARY)
def summary_without_stage(spark, sf_dir):
    """A10 over plans that are not staged."""
    checked = checked_rows_of(spark, sf_dir)
    return run_summary(checked, merged_customers(checked))


@query(f"{CTES} SELECT * FROM merged")
def published_customers(spark, sf_dir):
    """Staged, checked, committed together, and read back as the newest commit."""
    root = new_shared_path(spark, "published")
    publish_customers(consolidate(*raw_sources(spark, sf_dir)), root)
    return current(spark, root, "customer")


@query("""
    SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS id, c_custkey, c_acctbal FROM customer
""")
def surrogate_keys(spark, sf_dir):
    """Dense keys in a given order without a single-task sort."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return number_in_order(customers, [F.desc("c_acctbal"), "c_custkey"])


@query("""
    SELECT 'line key' AS check, CAST(l_orderkey AS VARCHAR) || ',' || CAST(l_linenumber AS VARCHAR) AS key,
           count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'order key', CAST(o_orderkey AS VARCHAR), count(*) FROM orders GROUP BY o_orderkey HAVING count(*) > 1
    UNION ALL SELECT 'event user', CAST(user_id AS VARCHAR), count(*) FROM events
      WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id
    UNION ALL SELECT 'order customer', CAST(o_custkey AS VARCHAR), count(*) FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
    UNION ALL SELECT 'error value', 'value_of_error', count(*) FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'price range', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), count(*) FROM lineitem
      WHERE l_extendedprice >= 99999.995 GROUP BY 2
    UNION ALL SELECT 'line required', 'l_orderkey', count(*) FROM lineitem WHERE l_orderkey IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'line required', 'price', count(*) FROM lineitem WHERE l_extendedprice IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'part required', 'p_name', count(*) FROM part WHERE p_name IS NULL HAVING count(*) > 0
    UNION ALL SELECT 'name length', p_name, count(*) FROM part WHERE length(p_name) > 10 GROUP BY p_name
""")
def integrity_report(spark, sf_dir):
    """J1-J5 JN4: duplicate keys, NULLs, orphans, ranges and lengths as one report; the column checks of a table in one scan."""
    read = lambda name: table(spark, sf_dir, name)
    error_value = F.when(F.col("event_type") == "error", F.col("value"))
    events = read("events").select("user_id", error_value.alias("value_of_error"))
    lines = read("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    parts = read("part").select("p_name")
    return integrity.violation_report(
        {
            "line key": integrity.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]),
            "order key": integrity.duplicate_keys(read("orders"), ["o_orderkey"]),
            "event user": integrity.orphans(events, "user_id", read("supplier"), "s_suppkey"),
            "order customer": integrity.orphans(read("orders"), "o_custkey", read("customer"), "c_custkey"),
        },
        integrity.column_findings(events, {"error value": integrity.required("value_of_error")}),
        integrity.column_findings(
            lines, {"line required": integrity.required("l_orderkey", "price"), "price range": integrity.in_range("price", 7, 2)}
        ),
        integrity.column_findings(
            parts, {"part required": integrity.required("p_name"), "name length": integrity.not_longer("p_name", 10)}
        ),
    )
