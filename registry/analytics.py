"""Reports, classes, grouping, text aggregation, word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from meldspark.functions.classify import ratio_class
from meldspark.operators.grouping import (
    class_stats,
    count_where,
    groups_with_at_least,
    surplus_rows,
    text_by_group,
    word_counts,
)
from meldspark.operators.merge import keep_first
from meldspark.plans.analytics import (
    frequent_wealth,
    frequent_wealth_sql,
    industries_outside,
    wealth_listing,
    wealth_stats,
    wealth_stats_sql,
    with_exact_wealth,
    with_wealth,
)
from meldspark.plans.person_tax import person_tax_report
from meldspark.sources.tables import as_view
from registry import query, spread_table, table

FLOORS = ((40_000, "rich"), (10_000, "middle"))


@query("""
    SELECT o_orderkey AS person_id, o_orderstatus || ' ' || o_orderpriority AS full_name,
           CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 20 AS DECIMAL(12,2)) AS income,
           if(c_acctbal * 20 < 20000, 'low', if(c_acctbal * 20 < 100000, 'mid', 'high')) AS income_bracket
    FROM orders, customer WHERE o_custkey = c_custkey
""")
def income_bracket_report(spark, sf_dir):
    """P1 P5 JN1 F1: orders play the persons, their customers the tax rows."""
    person = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", "o_orderstatus AS name", "o_orderpriority AS last_name", "o_custkey AS tax_id"
    )
    tax = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "CAST(c_acctbal AS DECIMAL(12,2)) * 20 AS income"
    )
    return person_tax_report(person, tax)


@query("""
    SELECT event_id AS person_id, event_type || ' ' || CAST(user_id AS VARCHAR) AS full_name,
           CAST(s_acctbal AS DECIMAL(12,2)) AS income,
           if(s_acctbal < 20000, 'low', if(s_acctbal < 100000, 'mid', 'high')) AS income_bracket
    FROM events JOIN supplier ON s_suppkey = user_id WHERE event_type <> 'error'
""")
def unmatched_dropped(spark, sf_dir):
    """JN1: persons whose tax id is NULL or has no tax row are left out."""
    person = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "event_type AS name", "CAST(user_id AS STRING) AS last_name",
        "CASE WHEN event_type <> 'error' THEN user_id END AS tax_id",
    )
    tax = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS income")
    return person_tax_report(person, tax)


@query("""
    SELECT l_orderkey, l_linenumber, l_suppkey, CAST(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END
             AS DECIMAL(12,2)) AS income,
           CASE WHEN l_returnflag = 'R' THEN 'high' WHEN l_extendedprice < 20000 THEN 'low'
                WHEN l_extendedprice < 100000 THEN 'mid' ELSE 'high' END AS income_bracket
    FROM lineitem
""")
def bracket_of_missing(spark, sf_dir):
    """P5: a missing income reaches no limit and falls to the last bracket."""
    from meldspark.functions.classify import income_bracket

    income = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).cast("decimal(12,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", income.alias("income"),
        income_bracket(income).alias("income_bracket"),
    )


@query("SELECT count(*) AS rows FROM customer WHERE c_mktsegment = 'BUILDING'")
def segment_count(spark, sf_dir):
    """P8 A1"""
    return count_where(table(spark, sf_dir, "customer"), F.col("c_mktsegment") == "BUILDING")


def _priced(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag AS continent",
        "CAST(round(l_extendedprice) AS BIGINT) AS gdp", "CAST(l_quantity AS BIGINT) AS population",
    )


PRICED = """
    priced AS (SELECT l_orderkey, l_linenumber, l_returnflag AS continent,
                      CAST(round(l_extendedprice) AS BIGINT) AS gdp, CAST(l_quantity AS BIGINT) AS population
               FROM lineitem),
    per_head AS (SELECT *, round(gdp / population, 1) AS per_head FROM priced),
    classed AS (SELECT *, if(per_head >= 40000, 'rich', if(per_head >= 10000, 'middle', 'poor')) AS wealth
                FROM per_head)
"""


@query(f"WITH {PRICED} SELECT * FROM classed")
def class_rows(spark, sf_dir):
    """Class of the rounded ratio."""
    return wealth_listing(with_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS))


@query(f"""
    WITH {PRICED} SELECT * EXCLUDE (per_head, wealth),
      if(gdp >= 40000 * population, 'rich', if(gdp >= 10000 * population, 'middle', 'poor')) AS wealth FROM classed
""")
def class_rows_exact(spark, sf_dir):
    """Class of the exact ratio."""
    return with_exact_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS)


@query(f"""
    WITH {PRICED} SELECT count(*) AS rows FROM classed
    WHERE wealth <> if(gdp >= 40000 * population, 'rich', if(gdp >= 10000 * population, 'middle', 'poor'))
""")
def class_rule_differences(spark, sf_dir):
    """Rows the two class rules put into different classes."""
    priced = _priced(spark, sf_dir)
    ratio = (F.col("gdp"), F.col("population"))
    return count_where(priced, ratio_class(*ratio, True, FLOORS) != ratio_class(*ratio, False, FLOORS))


STATS = f"""
    WITH {PRICED} SELECT wealth, count(*) AS members, CAST(sum(population) AS BIGINT) AS total_heads,
      round(avg(per_head), 1) AS mean_per_head FROM classed GROUP BY wealth
"""


@query(STATS)
def class_statistics(spark, sf_dir):
    """A2 O1 as DataFrame."""
    return wealth_stats(with_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS), "population")


@query(STATS)
def class_statistics_sql(spark, sf_dir):
    """A2 O1 P17 as SQL text."""
    return wealth_stats_sql(spark, with_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS), "population")


FREQUENT = f"""
    WITH {PRICED} SELECT continent, wealth, count(*) AS members FROM classed
    GROUP BY ALL HAVING count(*) >= 2000
"""


@query(FREQUENT)
def class_having(spark, sf_dir):
    """A3 A4 O2 as DataFrame."""
    return frequent_wealth(with_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS), "continent", 2000)


@query(FREQUENT)
def class_having_sql(spark, sf_dir):
    """A3 A4 O2 P17 as SQL text."""
    classed = with_wealth(_priced(spark, sf_dir), "gdp", "population", FLOORS)
    return frequent_wealth_sql(spark, classed, "continent", 2000)


@query("""
    SELECT o_orderpriority, o_orderstatus, count(*) AS rows FROM orders GROUP BY 1, 2 HAVING count(*) >= 900
""")
def group_sizes(spark, sf_dir):
    """A3 A4 O2"""
    return groups_with_at_least(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], 900)


@query("""
    SELECT p_brand, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS total_size,
           round(avg(p_size), 1) AS mean_size FROM part GROUP BY p_brand
""")
def brand_statistics(spark, sf_dir):
    """A2 over another table."""
    return class_stats(
        table(spark, sf_dir, "part"), "p_brand", "p_size", "p_size", ("parts", "total_size", "mean_size")
    )


def _companies(spark, sf_dir):
    from meldspark.session import broadcast_if_small

    nation = broadcast_if_small(table(spark, sf_dir, "nation"))
    home = F.when(F.col("n_name") != "NATION_7", F.col("n_name")).alias("country")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("c_name").alias("name"), home, F.col("c_mktsegment").alias("industry"))
    )


ABROAD = """
    abroad AS (SELECT nullif(c_mktsegment, 'BUILDING') AS industry, if(c_mktsegment = 'MACHINERY', NULL, c_name) AS name
               FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE nullif(n_name, 'NATION_7') <> 'NATION_0')
"""


def _companies_with_gaps(spark, sf_dir):
    """One industry without a name of its own, one whose companies have no names."""
    companies = _companies(spark, sf_dir)
    return companies.withColumn("name", F.when(F.col("industry") != "MACHINERY", F.col("name"))).withColumn(
        "industry", F.nullif("industry", F.lit("BUILDING"))
    )


@query(f"""
    WITH {ABROAD} SELECT industry, CAST(1 AS BIGINT) AS part, count(*) AS companies,
      coalesce(string_agg(name, ', ' ORDER BY name), '') AS names FROM abroad GROUP BY industry HAVING count(*) >= 2
""")
def names_by_group(spark, sf_dir):
    """Names abroad by industry; rows without a country are left out, NULL is an industry too."""
    return industries_outside(_companies_with_gaps(spark, sf_dir), "NATION_0")


@query(f"""
    WITH {ABROAD}, placed AS (
      SELECT *, count(*) OVER (PARTITION BY industry) AS rows, CAST(floor(coalesce(sum(length(name) + 2) OVER (
        PARTITION BY industry ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2000) + 1 AS BIGINT)
        AS part FROM abroad)
    SELECT industry, part, rows, coalesce(string_agg(name, ', ' ORDER BY name), '') AS text FROM placed
    GROUP BY industry, part, rows
""")
def names_in_parts(spark, sf_dir):
    """A5 with groups longer than one text may be: numbered parts, nothing left out."""
    abroad = _companies_with_gaps(spark, sf_dir).filter(F.col("country") != "NATION_0")
    return text_by_group(abroad, ["industry"], "name", max_text=2000)


WORDS = r"unnest(string_split_regex(text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+')) AS word"


@query(f"SELECT word, count(*) AS count FROM (SELECT {WORDS} FROM documents) WHERE word <> '' GROUP BY word")
def word_count(spark, sf_dir):
    """A13 F20 X3 over whole documents."""
    return word_counts(spread_table(spark, sf_dir, "documents", "text"), "text")


@query(f"SELECT word, count(*) AS count FROM (SELECT {WORDS} FROM conversations) WHERE word <> '' GROUP BY word")
def word_count_conversations(spark, sf_dir):
    """A13 F20 over conversation turns."""
    return word_counts(spread_table(spark, sf_dir, "conversations", "text"), "text")


@query("""
    SELECT (SELECT count(*) - count(DISTINCT user_id) FROM events) AS surplus
""")
def surplus_keys(spark, sf_dir):
    """Rows beyond the first per key."""
    return surplus_rows(table(spark, sf_dir, "events"), "user_id")


@query("SELECT DISTINCT lang, source FROM documents")
def distinct_pairs(spark, sf_dir):
    """A12"""
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query("""
    SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def first_order_of_customer(spark, sf_dir):
    """First order per customer."""
    return keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations WHERE text LIKE '%,%' AND role <> 'user'")
def comma_turns(spark, sf_dir):
    """P12 P13 F19"""
    turns = table(spark, sf_dir, "conversations")
    return turns.filter(F.col("text").like("%,%") & (F.col("role") != "user")).select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("n_chars")
    )


@query("SELECT * FROM customer WHERE c_custkey = 7")
def point_lookup(spark, sf_dir):
    """One row by key; the filter reaches the scan."""
    return table(spark, sf_dir, "customer").filter(F.col("c_custkey") == 7)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def first_of_result(spark, sf_dir):
    """First row of an ordered result."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)


@query("""
    WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders GROUP BY o_custkey)
    SELECT c_mktsegment, count(*) AS customers, CAST(max(total) AS DECIMAL(22,2)) AS best
    FROM spent JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment
""")
def best_customers(spark, sf_dir):
    """A named subquery over registered views."""
    as_view(table(spark, sf_dir, "orders"), "orders_view")
    as_view(table(spark, sf_dir, "customer"), "customer_view")
    return spark.sql("""
        WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total
                       FROM orders_view GROUP BY o_custkey)
        SELECT c_mktsegment, count(*) AS customers, max(total) AS best
        FROM spent JOIN customer_view ON c_custkey = o_custkey GROUP BY c_mktsegment
    """)
