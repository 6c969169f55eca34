"""Text cleaning, lenient parsing, lookups. The texts are built from whole tables by SQL both engines share."""

from __future__ import annotations

from pyspark.sql import functions as F

from meldspark.functions import parse, text
from meldspark.operators.lookup import lookup_left
from meldspark.operators.rules import full_match
from meldspark.plans.customers import EMAIL_PATTERN
from meldspark.sources.countries import COUNTRIES, country_dictionary, country_spellings
from registry import query, spread_table, table
from registry.raw_sources import RAW_CTES, crm_rows, legacy_rows, webshop_rows

N = "CAST({} AS STRING)".format

# Days 0 to 32, months 0 to 13, years of one to five digits, padding, doubled separators.
DATE_TEXTS = f"""
SELECT o_orderkey,
  CASE o_orderkey % 17 WHEN 0 THEN ' ' WHEN 1 THEN '0' ELSE '' END || {N('o_orderkey % 33')} || '.'
    || CASE o_orderkey % 19 WHEN 0 THEN '0' WHEN 1 THEN '.' ELSE '' END || {N('o_orderkey % 14')} || '.'
    || CASE o_orderkey % 23 WHEN 0 THEN {N('1 + o_orderkey % 99')} WHEN 1 THEN '' WHEN 2 THEN '12345'
       ELSE {N('1900 + o_orderkey % 150')} END || CASE o_orderkey % 29 WHEN 0 THEN '  ' WHEN 1 THEN 'x' ELSE '' END
    AS dotted,
  CASE o_orderkey % 31 WHEN 0 THEN {N('o_orderkey % 900 + 1')} ELSE {N('1800 + o_orderkey % 300')} END || '-'
    || {N('o_orderkey % 14')} || '-' || {N('o_orderkey % 32')} AS iso,
  {N('1800 + o_orderkey % 300')} || '/' || lpad({N('o_orderkey % 14')}, 2, '0') || '/'
    || lpad({N('o_orderkey % 32')}, 2, '0') AS slashed,
  {N('1980 + o_orderkey % 60')} || '-' || {N('1 + o_orderkey % 12')} || '-' || {N('1 + o_orderkey % 30')}
    || CASE o_orderkey % 37 WHEN 0 THEN 'T' WHEN 1 THEN '  ' WHEN 2 THEN '' ELSE ' ' END || {N('o_orderkey % 25')}
    || ':' || {N('o_orderkey % 61')} || CASE o_orderkey % 41 WHEN 0 THEN '' ELSE ':' || {N('o_orderkey % 60')} END
    AS spaced,
  {N('1980 + o_orderkey % 60')} || '-' || {N('1 + o_orderkey % 12')} || '-' || {N('1 + o_orderkey % 30')} || 'T'
    || {N('o_orderkey % 25')} || ':' || {N('o_orderkey % 61')} || ':' || {N('o_orderkey % 60')}
    || CASE o_orderkey % 43 WHEN 0 THEN '' WHEN 1 THEN 'z' ELSE 'Z' END AS zulu
FROM {{orders}}
"""


@query(f"""
    SELECT o_orderkey, try_strptime(dotted, '%d.%m.%Y')::DATE AS dotted, try_strptime(iso, '%Y-%m-%d')::DATE AS iso,
           try_strptime(slashed, '%Y/%m/%d')::DATE AS slashed,
           try_strptime(spaced, '%Y-%m-%d %H:%M:%S') AS spaced, try_strptime(zulu, '%Y-%m-%dT%H:%M:%SZ') AS zulu
    FROM ({DATE_TEXTS.format(orders='orders')})
""")
def parse_dates(spark, sf_dir):
    """F10 F11 F12"""
    texts = spark.sql(DATE_TEXTS, orders=spread_table(spark, sf_dir, "orders", "o_orderkey"))
    return texts.select(
        "o_orderkey",
        parse.parse_date("dotted", parse.DAY_DOTTED).alias("dotted"),
        parse.parse_date("iso", parse.ISO_DAY).alias("iso"),
        parse.parse_date("slashed", parse.SLASHED_DAY).alias("slashed"),
        parse.parse_timestamp("spaced", parse.SPACED_TIME).alias("spaced"),
        parse.parse_timestamp("zulu", parse.ZULU_TIME).alias("zulu"),
    )


# Every line of lineitem as money text: three decimals, commas, exponents, separators, padding, overflow, junk.
NUMBER_TEXTS = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE (l_orderkey + l_partkey) % 16
    WHEN 0 THEN replace({N('CAST(l_extendedprice AS DECIMAL(12,2))')}, '.', ',')
    WHEN 1 THEN ' ' || {N('CAST(l_extendedprice AS DECIMAL(12,2))')} || ' '
    WHEN 2 THEN '-' || {N('CAST(l_extendedprice AS DECIMAL(12,2))')}
    WHEN 3 THEN {N('l_partkey')} || 'e3'
    WHEN 4 THEN {N('l_partkey')} || '_000'
    WHEN 5 THEN '1.' || {N('CAST(l_extendedprice AS DECIMAL(12,2))')}
    WHEN 6 THEN '99999999' || {N('l_partkey')}
    WHEN 7 THEN 'N/A'
    WHEN 8 THEN '' WHEN 9 THEN '.' || {N('l_partkey')} WHEN 10 THEN {N('l_partkey')} || '.'
    ELSE {N('CAST(l_extendedprice AS DECIMAL(12,2))')} || {N('l_linenumber')} END AS money,
  CASE (l_orderkey + l_partkey) % 13
    WHEN 0 THEN {N('l_orderkey')} || '.5' WHEN 1 THEN '-' || {N('l_orderkey')} || '.5' WHEN 2 THEN {N('l_orderkey')} || 'e2'
    WHEN 3 THEN '922337203685477' || {N('1000 + l_orderkey % 9000')} WHEN 4 THEN '0x' || {N('l_orderkey')}
    WHEN 5 THEN ' ' || {N('l_orderkey')} || ' ' WHEN 6 THEN 'id' || {N('l_orderkey')}
    WHEN 7 THEN {N('l_orderkey')} || '.49999999999999999999' WHEN 8 THEN '+' || {N('l_orderkey')}
    WHEN 9 THEN '1_' || {N('100 + l_orderkey')} ELSE {N('l_orderkey')} END AS whole
FROM {{lineitem}}
"""


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, TRY_CAST(trim(money) AS DECIMAL(12,2)) AS point,
           TRY_CAST(translate(trim(money), ',', '.') AS DECIMAL(12,2)) AS comma, TRY_CAST(trim(whole) AS BIGINT) AS whole
    FROM ({NUMBER_TEXTS.format(lineitem='lineitem')})
""")
def parse_numbers(spark, sf_dir):
    """F7 F13 F14"""
    texts = spark.sql(NUMBER_TEXTS, lineitem=spread_table(spark, sf_dir, "lineitem"))
    return texts.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        parse.parse_decimal("money").alias("point"),
        parse.parse_decimal("money", comma=True).alias("comma"),
        parse.parse_whole_number("whole").alias("whole"),
    )


FLAG_TEXTS = """
SELECT event_id,
  CASE event_id % 22 WHEN 0 THEN 'true' WHEN 1 THEN 'FALSE' WHEN 2 THEN 't' WHEN 3 THEN 'F' WHEN 4 THEN 'yes'
    WHEN 5 THEN 'No' WHEN 6 THEN 'y' WHEN 7 THEN 'N' WHEN 8 THEN '1' WHEN 9 THEN '0' WHEN 10 THEN ' true'
    WHEN 11 THEN 'on' WHEN 12 THEN '' WHEN 13 THEN 'maybe' WHEN 14 THEN ' Y ' WHEN 15 THEN 'n ' WHEN 16 THEN 'Active'
    WHEN 17 THEN ' INACTIVE' WHEN 18 THEN 'pending' WHEN 19 THEN '2' ELSE event_type END AS flag
FROM {events}
"""


@query(f"""
    SELECT event_id, TRY_CAST(flag AS BOOLEAN) AS truth,
           CASE lower(trim(flag)) WHEN 'y' THEN true WHEN 'n' THEN false END AS letter,
           CASE lower(trim(flag)) WHEN 'active' THEN true WHEN 'inactive' THEN false END AS state
    FROM ({FLAG_TEXTS.format(events='events')})
""")
def parse_flags(spark, sf_dir):
    """F15 F16"""
    texts = spark.sql(FLAG_TEXTS, events=spread_table(spark, sf_dir, "events", "event_id", "event_type"))
    return texts.select(
        "event_id",
        parse.parse_boolean("flag").alias("truth"),
        parse.parse_flag("flag", "Y", "N").alias("letter"),
        parse.parse_flag("flag", "active", "inactive").alias("state"),
    )


PADDED_NAMES = f"""
SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN '  ' WHEN 1 THEN ' ' WHEN 2 THEN '' ELSE ' ' END
  || CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN '' WHEN 2 THEN 'élan ' || p_name WHEN 3 THEN 'İZ ' || p_type
     ELSE p_name || ',' || p_brand END || CASE p_partkey % 3 WHEN 0 THEN '  ' ELSE '' END AS name
FROM {{part}}
"""
CLEANED = f"""
    SELECT p_partkey, nullif(trim(name), '') AS clean,
           upper(left(nullif(trim(name), ''), 1)) || lower(substr(nullif(trim(name), ''), 2)) AS proper
    FROM ({PADDED_NAMES.format(part='part')})
"""


@query(CLEANED)
def clean_text(spark, sf_dir):
    """F2 F3 F4 F5 F6 as column functions."""
    names = spark.sql(PADDED_NAMES, part=table(spark, sf_dir, "part"))
    return names.select(
        "p_partkey", text.blank_to_null("name").alias("clean"), text.proper_case("name").alias("proper")
    )


@query(CLEANED)
def clean_text_sql(spark, sf_dir):
    """The same as functions inside SQL text."""
    text.register_sql_functions(spark)
    return spark.sql(
        "SELECT p_partkey, blank_to_null(name) AS clean, proper_case(name) AS proper FROM {names}",
        names=spark.sql(PADDED_NAMES, part=table(spark, sf_dir, "part")),
    )


@query(f"""
    WITH {RAW_CTES} SELECT source_row, split_part(name, ',', 1) AS last_part, split_part(name, ',', 2) AS first_part,
      split_part(name, ',', 3) AS no_part FROM legacy
""")
def split_names(spark, sf_dir):
    """F8: a missing part is empty text."""
    names = legacy_rows(spark, sf_dir)
    parts = [F.split_part("name", F.lit(","), F.lit(n)).alias(a) for n, a in ((1, "last_part"), (2, "first_part"), (3, "no_part"))]
    return names.select("source_row", *parts)


@query(f"""
    WITH {RAW_CTES}, emails AS (
      SELECT 'crm' AS source, source_row, email FROM crm UNION ALL
      SELECT 'webshop', source_row, email FROM webshop UNION ALL SELECT 'legacy', source_row, email FROM legacy)
    SELECT source, source_row, lower(email) AS email,
           regexp_full_match(lower(email), '[^@ ]+@[^@ ]+[.][a-z]{{2,}}') AS valid FROM emails
""")
def email_check(spark, sf_dir):
    """P11 U1 P4"""
    parts = [
        rows(spark, sf_dir).select(F.lit(name).alias("source"), "source_row", text.lower_text(email).alias("email"))
        for name, rows, email in (
            ("crm", crm_rows, "email"), ("webshop", webshop_rows, "email"), ("legacy", legacy_rows, "contact.email")
        )
    ]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return united.withColumn("valid", full_match(F.col("email"), EMAIL_PATTERN))


def sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


DICTIONARY_ROWS = ", ".join(
    f"({i}, '{e.code}', '{e.name}', '{e.native_name}', {sql_list(e.variants)}, '{e.phone_prefix}', '{e.postal_pattern}')"
    for i, e in enumerate(COUNTRIES)
)
SPELLING_CTES = f"""
    dictionary AS (SELECT * FROM (VALUES {DICTIONARY_ROWS}) AS d(ordinal, code, name, native_name, variants,
                   phone_prefix, postal_pattern)),
    spelling AS (SELECT lower(trim(word)) AS spelling, arg_max(code, ordinal) AS code
                 FROM (SELECT ordinal, code, unnest(list_concat([code, name, native_name], variants)) AS word
                       FROM dictionary) GROUP BY 1)
"""


@query(f"""
    WITH {RAW_CTES}, {SPELLING_CTES}
    SELECT source_row, country, spelling.code AS country_code
    FROM crm LEFT JOIN spelling ON spelling.spelling = lower(trim(country))
""")
def spelling_lookup(spark, sf_dir):
    """S9 S10 JN2: country codes by any spelling, unknown ones stay without a code."""
    spellings = country_spellings(country_dictionary(spark))
    rows = crm_rows(spark, sf_dir).select("source_row", "country")
    return lookup_left(rows, text.spelling_key("country"), spellings, "spelling", "code", "country_code")


@query(r"""
    SELECT word, lower(regexp_replace(strip_accents(translate(word, 'łŁ', 'lL')), '[^A-Za-z0-9]', '', 'g')) AS folded
    FROM (SELECT DISTINCT unnest(string_split_regex(text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+')) AS word FROM documents)
    WHERE word <> ''
""")
def fold_words(spark, sf_dir):
    """F23 over every distinct word."""
    found = spread_table(spark, sf_dir, "documents", "text").select(F.explode(text.words("text")).alias("word")).distinct()
    return found.select("word", text.ascii_fold("word").alias("folded"))


@query(r"""
    SELECT conv_id, turn, array_to_string(list_transform(range(1, len(letters) + 1), lambda i:
             if(i > 1 AND regexp_full_match(letters[i - 1], '\p{L}'), lower(letters[i]),
                if(letters[i] = 'ß', 'Ss', upper(letters[i])))), '') AS title
    FROM (SELECT conv_id, turn, string_split(text, '') AS letters FROM conversations)
""")
def title_texts(spark, sf_dir):
    """F28 over whole texts."""
    return spread_table(spark, sf_dir, "conversations").select("conv_id", "turn", text.title_case("text").alias("title"))


@query("""
    SELECT conv_id, turn, CAST(to_json(text) AS VARCHAR) AS quoted, length(text) AS n_chars FROM conversations
""")
def quoted_texts(spark, sf_dir):
    """JSON string literals of whole texts."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.json_quoted("text").alias("quoted"), F.length("text").cast("bigint").alias("n_chars")
    )


@query("""
    SELECT c_custkey, replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS money,
           CAST(greatest(CAST(round(c_acctbal * 100) AS BIGINT), 1) AS BIGINT) AS at_least_one_cent,
           -greatest(CAST(round(c_acctbal * 100) AS BIGINT), 1) AS owed
    FROM customer
""")
def money_texts(spark, sf_dir):
    """F22 F29"""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    floor = F.greatest(cents, F.lit(1).cast("bigint"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.money_text(cents, ",").alias("money"), floor.alias("at_least_one_cent"),
        (-floor).alias("owed"),
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS dotted, strftime(o_orderdate, '%Y/%m/%d') AS slashed,
           CAST(o_orderdate AS DATE) + CAST(o_custkey AS INTEGER) AS later_day,
           o_orderdate + to_seconds(o_orderkey) AS later_second
    FROM orders
""")
def date_texts(spark, sf_dir):
    """F21 F27"""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(day, "dd.MM.yyyy").alias("dotted"), F.date_format(day, "yyyy/MM/dd").alias("slashed"),
        F.date_add(day, F.col("o_custkey").cast("int")).alias("later_day"),
        F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("later_second"),
    )
