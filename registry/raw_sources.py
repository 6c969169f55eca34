"""Three raw customer sources derived from whole tables: crm from customer, webshop from orders, legacy from events.

The SQL below runs unchanged on both engines: it only builds text. Every row stays; which rows get a bad value
follows from their key, so that each rejection reason occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from registry import spread_table


def _pad(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


def _text(number: str) -> str:
    return f"CAST({number} AS STRING)"


CRM_SQL = f"""
SELECT c_custkey + 1 AS source_row,
  CASE c_custkey % 29 WHEN 1 THEN 'abc' WHEN 2 THEN {_text('c_custkey')} || '.4' WHEN 3 THEN ' ' || {_text('c_custkey')}
    WHEN 4 THEN CAST(NULL AS STRING) WHEN 5 THEN '9223372036854775808' ELSE {_text('c_custkey')} END AS customer_id,
  CASE c_custkey % 31 WHEN 1 THEN '   ' ELSE '  ' || c_mktsegment || ' ' END AS first_name,
  replace(c_name, '#', ' ') AS last_name,
  CASE c_custkey % 23 WHEN 1 THEN '' WHEN 2 THEN lower(c_mktsegment) || '#example.com'
    WHEN 3 THEN lower(c_mktsegment) || ' at example.com' WHEN 4 THEN lower(c_mktsegment) || '@example'
    ELSE c_mktsegment || {_text('c_custkey')} || '@Example.COM' END AS email,
  CASE c_custkey % 7 WHEN 1 THEN ' ' ELSE '+48 ' || {_text('100 + c_custkey % 900')} END AS phone,
  CASE c_custkey % 19 WHEN 1 THEN 'unknown' WHEN 2 THEN '31.02.1990' WHEN 3 THEN '00.00.0000' WHEN 4 THEN ''
    WHEN 5 THEN ' ' || {_text('1 + c_custkey % 9')} || '.' || {_text('1 + c_custkey % 9')} || '.1990 '
    ELSE {_pad('1 + c_custkey % 28')} || '.' || {_pad('1 + c_custkey % 12')} || '.' || {_text('1940 + c_custkey % 68')}
    END AS birth_date,
  'Polna ' || {_text('1 + c_custkey % 250')} AS street,
  ' City ' || {_text('c_nationkey')} AS city,
  {_pad('c_custkey % 97')} || '-' || {_text('100 + c_custkey % 899')} AS postal_code,
  CASE c_nationkey % 9 WHEN 0 THEN ' POLAND ' WHEN 1 THEN 'germany' WHEN 2 THEN 'Rzeczpospolita Polska'
    WHEN 3 THEN 'España' WHEN 4 THEN 'U.S.A.' WHEN 5 THEN 'Great Britain' WHEN 6 THEN 'ČESKO' WHEN 7 THEN 'it'
    ELSE 'Atlantis' END AS country,
  CASE c_custkey % 17 WHEN 1 THEN '2020-01-01 24:00:00' WHEN 2 THEN '2020-01-01T10:00:00Z'
    ELSE {_text('2015 + c_custkey % 11')} || '-' || {_pad('1 + c_custkey % 12')} || '-' || {_pad('1 + c_custkey % 28')}
    || ' ' || {_pad('c_custkey % 24')} || ':' || {_pad('c_custkey % 60')} || ':' || {_pad('c_custkey % 59')}
    END AS registered_at,
  CASE c_custkey % 13 WHEN 1 THEN 'X' WHEN 2 THEN ' y ' WHEN 3 THEN 'n' WHEN 4 THEN 'N' ELSE 'Y' END AS active,
  CASE c_custkey % 37 WHEN 1 THEN 'N/A' WHEN 2 THEN '12.34.56' WHEN 3 THEN '12,345' WHEN 4 THEN '1.234,50'
    ELSE replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING), '.', ',') END AS lifetime_value
FROM {{customer}}
"""

WEBSHOP_SQL = f"""
SELECT o_orderkey + 1 AS source_row,
  CASE o_orderkey % 41 WHEN 1 THEN '' WHEN 2 THEN {_text('o_custkey')} || '.5' ELSE {_text('o_custkey')} END AS id,
  lower(substr(o_orderpriority, 3)) AS first_name_text,
  CASE o_orderkey % 43 WHEN 1 THEN CAST(NULL AS STRING) ELSE 'mc' || o_orderstatus || 'DONALD' END AS last_name_text,
  CASE o_orderkey % 47 WHEN 1 THEN CAST(NULL AS STRING) WHEN 2 THEN 'a b@c.de'
    ELSE 'shop.' || {_text('o_orderkey')} || '@post.example.org' END AS email,
  '+1 ' || {_text('o_orderkey')} AS phone,
  CASE o_orderkey % 53 WHEN 1 THEN '1990-02-31' WHEN 2 THEN 'n/a' WHEN 3 THEN '90-1-2'
    ELSE {_text('1940 + o_orderkey % 68')} || '-' || {_pad('1 + o_orderkey % 12')} || '-' || {_text('1 + o_orderkey % 28')}
    END AS birth_text,
  'Main Street ' || {_text('o_orderkey % 250')} AS street,
  '' AS city,
  {_text('10000 + o_orderkey % 89999')} AS zip,
  CASE o_orderkey % 8 WHEN 0 THEN 'PL' WHEN 1 THEN 'DE' WHEN 2 THEN 'fr' WHEN 3 THEN ' ES' WHEN 4 THEN 'IT'
    WHEN 5 THEN 'GB' WHEN 6 THEN 'US' ELSE CASE o_orderkey % 59 WHEN 1 THEN 'XX' ELSE 'CZ' END END AS country_code,
  CASE o_orderkey % 61 WHEN 1 THEN '2020-01-01 10:00:00' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T'
    || {_pad('o_orderkey % 24')} || ':' || {_pad('o_orderkey % 60')} || ':07Z' END AS created_text,
  CASE o_orderkey % 11 WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN 'F' WHEN 4 THEN
    CASE o_orderkey % 67 WHEN 1 THEN 'maybe' ELSE 'no' END ELSE 'true' END AS active,
  CASE o_orderkey % 71 WHEN 1 THEN 'unknown' WHEN 2 THEN '-0.01' WHEN 3 THEN '1e3'
    ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS ltv
FROM {{orders}}
"""

LEGACY_SQL = f"""
SELECT event_id + 1 AS source_row,
  CASE event_id % 73 WHEN 1 THEN 'x' ELSE {_text('user_id')} END AS member_id,
  CASE event_id % 79 WHEN 1 THEN 'Solo' WHEN 2 THEN ', ' || event_type
    ELSE upper(event_type) || ', ' || event_type || ' ' || {_text('user_id')} END AS name,
  CASE event_id % 83 WHEN 1 THEN 'a@b' WHEN 2 THEN ' ' ELSE event_type || {_text('event_id')} || '@inbox.example.org'
    END AS email,
  CASE event_id % 3 WHEN 1 THEN CAST(NULL AS STRING) ELSE '+420 ' || {_text('event_id')} END AS phone,
  CASE event_id % 89 WHEN 1 THEN '1990-01-02' ELSE {_text('1950 + event_id % 50')} || '/' || {_text('1 + event_id % 12')}
    || '/' || {_text('1 + event_id % 28')} END AS born,
  'Luční ' || {_text('event_id % 99')} AS street, 'Zlín' AS city, {_text('event_id % 1000')} AS postcode,
  CASE event_id % 5 WHEN 0 THEN 'polska' WHEN 1 THEN 'deutschland' WHEN 2 THEN 'españa' WHEN 3 THEN 'italia'
    ELSE CASE event_id % 97 WHEN 1 THEN 'narnia' ELSE 'česko' END END AS country,
  CASE event_id % 101 WHEN 1 THEN '2024-01-01 10:00' ELSE CAST(CAST(ts AS DATE) AS STRING) || ' '
    || {_text('event_id % 24')} || ':' || {_text('event_id % 60')} || ':' || {_text('event_id % 60')} END AS joined,
  CASE event_id % 103 WHEN 1 THEN 'pending' WHEN 2 THEN ' INACTIVE' ELSE 'active' END AS status,
  CASE event_id % 107 WHEN 1 THEN '12.34.56' WHEN 2 THEN '-5'
    ELSE CAST(CAST(value AS DECIMAL(12,2)) AS STRING) END AS value
FROM {{events}}
"""

# The same text with the tables' own names, as common table expressions.
RAW_CTES = f"""
crm AS ({CRM_SQL.format(customer='customer')}),
webshop AS ({WEBSHOP_SQL.format(orders='orders')}),
legacy AS ({LEGACY_SQL.format(events='events')})
"""


def crm_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CRM_SQL, customer=spread_table(spark, sf_dir, "customer"))


def webshop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the nested shape of the source."""
    flat = spark.sql(WEBSHOP_SQL, orders=spread_table(spark, sf_dir, "orders"))
    return flat.selectExpr(
        "source_row", "id", "first_name_text AS firstName", "last_name_text AS lastName", "email", "phone",
        "birth_text AS birthDate",
        "struct(street, city, zip, country_code AS countryCode) AS address",
        "created_text AS createdAt", "active", "ltv",
    )


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the nested shape of the source."""
    flat = spark.sql(LEGACY_SQL, events=spread_table(spark, sf_dir, "events"))
    return flat.selectExpr(
        "source_row", "member_id", "name", "struct(email, phone) AS contact", "born",
        "struct(street, city, postcode, country) AS location", "joined", "status", "value",
    )
