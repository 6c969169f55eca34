"""Person-tax report and country/company analytics on small literal tables with known results."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meldspark.operators import integrity
from meldspark.operators.grouping import count_where, text_by_group, word_counts
from meldspark.plans import analytics
from meldspark.plans.person_tax import REPORT_TYPES, JdbcSplit, RepeatedPerson, person_tax_report, run_person_tax
from meldspark.sinks.jdbc import jdbc_write_options, replace_table
from meldspark.sources.tables import inferred_table, jdbc_scan_options, line_table, typed_table

INCOMES = [Decimal(7919 * i % 220_000) + Decimal("0.25") for i in range(1, 101)]

PERSON = "id int, name string, last_name string, tax_id int"
TAX = "id int, income decimal(12,2)"


def tables(spark):
    person = typed_table(spark, [(i + 1, f"First{i + 1}", "Last", 1000 - i) for i in range(len(INCOMES))], PERSON)
    tax = typed_table(spark, [(1000 - i, v) for i, v in enumerate(INCOMES)], TAX)
    return person, tax


def test_seeded_report(spark):
    report = person_tax_report(*tables(spark))
    found = {r.income_bracket: (r.n, r.total) for r in report.groupBy("income_bracket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("income").alias("total")).collect()}
    expected = {}
    for name, low, high in (("low", 0, 20_000), ("mid", 20_000, 100_000), ("high", 100_000, 10**9)):
        inside = [v for v in INCOMES if low <= v < high]
        expected[name] = (len(inside), sum(inside))
    assert found == expected
    assert tuple(report.filter("person_id = 100").first()) == (100, "First100 Last", Decimal("131900.25"), "high")


def test_first_person_and_missing_tax_rows(spark):
    person = typed_table(
        spark, [(1, "James", "Smith", 482), (2, "No", "Row", 999), (3, "No", "Tax", None), (4, None, "X", 482)], PERSON
    )
    tax = typed_table(spark, [(482, Decimal("123000.33"))], TAX)
    rows = sorted(map(tuple, person_tax_report(person, tax).collect()))
    assert rows == [(1, "James Smith", Decimal("123000.33"), "high"), (4, None, Decimal("123000.33"), "high")]


def test_run_replaces_table_and_writes_parquet_only_on_request(spark, tmp_path):
    person, tax = tables(spark)
    load = lambda report: replace_table(report, "person_tax_report")
    path = str(tmp_path / "report")
    run_person_tax(person, tax, load)
    assert not (tmp_path / "report").exists()
    run_person_tax(person, tax, load, path)
    run_person_tax(person, tax, load, path)
    assert spark.table("person_tax_report").count() == 100
    assert spark.read.parquet(path).count() == 100
    spark.sql("DROP TABLE person_tax_report")


def test_repeated_person_stops_the_run(spark):
    person, tax = tables(spark)
    loaded = []
    with pytest.raises(RepeatedPerson, match="person_id key: 3 "):
        run_person_tax(person.union(person.filter("id = 3")), tax, loaded.append)
    assert not loaded


def test_long_names_are_loaded_whole(spark):
    person = typed_table(spark, [(1, "x" * 5000, "y", 1)], PERSON)
    tax = typed_table(spark, [(1, Decimal(1))], TAX)
    assert len(person_tax_report(person, tax).first().full_name) == 5002 and "full_name" not in REPORT_TYPES


def test_jdbc_options():
    scan = jdbc_scan_options("jdbc:x", "person", "id", (1, 100), 4, user="u")
    assert scan["partitionColumn"] == "id" and scan["numPartitions"] == "4" and scan["user"] == "u"
    assert "partitionColumn" not in jdbc_scan_options("jdbc:x", "person")
    with pytest.raises(ValueError):
        jdbc_scan_options("jdbc:x", "person", "id")
    split = JdbcSplit("id", (1, 9), 3)
    assert jdbc_scan_options("jdbc:x", "person", **split.options())["upperBound"] == "9"
    write = jdbc_write_options("jdbc:x", "report", column_types="a VARCHAR(9)")
    assert write["createTableColumnTypes"] == "a VARCHAR(9)" and write["batchsize"] == "10000"


# The two country data sets differ only in the rows of Russia and Turkey.
COUNTRIES = [
    ("India", "Asia", 1464, 4190), ("China", "Asia", 1416, 19400), ("United States", "North America", 347, 30510),
    ("Indonesia", "Asia", 286, 1430), ("Pakistan", "Asia", 255, 410), ("Nigeria", "Africa", 238, 188),
    ("Brazil", "South America", 213, 2260), ("Bangladesh", "Asia", 176, 467), ("Russia", "Europe", 144, 2540),
    ("Russia", "Asia", 144, 2540), ("Ethiopia", "Africa", 135, 109), ("Mexico", "North America", 132, 1860),
    ("Japan", "Asia", 123, 4280), ("Egypt", "Africa", 118, 347), ("Philippines", "Asia", 117, 497),
    ("Democratic Republic of the Congo", "Africa", 113, 79), ("Vietnam", "Asia", 102, 506), ("Iran", "Asia", 92, 357),
    ("Turkey", "Europe", 88, 1440), ("Turkey", "Asia", 88, 1440), ("Germany", "Europe", 84, 4740),
    ("Thailand", "Asia", 72, 559), ("Poland", "Europe", 38, 915),
]
SPLIT_ROWS = {
    ("Russia", "Europe"): (100, 2000), ("Russia", "Asia"): (44, 540), ("Turkey", "Europe"): (1, 40),
    ("Turkey", "Asia"): (87, 1400),
}


@pytest.fixture(scope="module")
def classed(spark):
    countries = inferred_table(spark, COUNTRIES, ["country", "continent", "population", "gdp"])
    return analytics.with_wealth(countries, "gdp", "population")


def test_inferred_types(classed):
    kinds = {f.name: f.dataType.simpleString() for f in classed.schema}
    assert kinds["population"] == "bigint" and kinds["country"] == "string" and kinds["per_head"] == "double"


def test_country_statistics(spark, classed):
    assert count_where(classed, F.col("continent") == "Asia").first()[0] == 12
    expected = [("rich", 4, 592, 50.8), ("middle", 10, 2685, 12.4), ("poor", 9, 2708, 2.3)]
    assert [tuple(r) for r in analytics.wealth_stats(classed, "population").collect()] == expected
    assert [tuple(r) for r in analytics.wealth_stats_sql(spark, classed, "population").collect()] == expected


def test_countries_having(spark, classed):
    expected = [("Africa", "poor", 4), ("Asia", "middle", 6), ("Asia", "poor", 5), ("Europe", "middle", 2),
                ("Europe", "rich", 2)]
    assert [tuple(r) for r in analytics.frequent_wealth(classed, "continent").collect()] == expected
    assert [tuple(r) for r in analytics.frequent_wealth_sql(spark, classed, "continent").collect()] == expected


def test_exact_class_on_the_other_data(spark):
    rows = [(c, k, *SPLIT_ROWS.get((c, k), (p, g))) for c, k, p, g in COUNTRIES]
    countries = inferred_table(spark, rows, ["country", "continent", "population", "gdp"])
    exact = analytics.with_exact_wealth(countries, "gdp", "population")
    assert [tuple(r) for r in analytics.frequent_wealth(exact, "continent").collect()] == [
        ("Africa", "poor", 4), ("Asia", "middle", 5), ("Asia", "poor", 6), ("Europe", "rich", 4)
    ]


def test_industries_outside(spark):
    companies = inferred_table(
        spark,
        [(1, "Apple", "United States", "Technology"), (2, "Microsoft", "United States", "Technology"),
         (3, "Saudi Aramco", "Saudi Arabia", "Energy"), (4, "Shell", "United Kingdom", "Energy"),
         (5, "Toyota", "Japan", "Automotive"), (6, "Volkswagen", "Germany", "Automotive"),
         (7, "Samsung Electronics", "South Korea", "Technology"), (8, "TSMC", "Taiwan", "Semiconductors"),
         (9, "Nestle", "Switzerland", "Food"), (10, "LVMH", "France", "Luxury Goods"),
         (11, "Nowhere", None, "Food")],
        ["company_id", "name", "country", "industry"],
    )
    rows = analytics.industries_outside(companies, "United States").orderBy("industry").collect()
    assert [(r.industry, r.companies, r.names) for r in rows] == [
        ("Automotive", 2, "Toyota, Volkswagen"), ("Energy", 2, "Saudi Aramco, Shell")
    ]


def test_word_count(spark):
    lines = line_table(spark, ["hello spark", "hello world", "spark is fast and spark is fun"])
    assert [tuple(r) for r in word_counts(lines, "line").collect()] == [
        ("spark", 3), ("hello", 2), ("is", 2), ("and", 1), ("fast", 1), ("fun", 1), ("world", 1)
    ]


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_long_groups_come_in_whole_parts(spark, partitions):
    """One group holds most rows, most of them copies of one value: nothing is lost and no part is too long."""
    rows = [("hot", f"n{i % 40:02d}") for i in range(400)] + [("hot", "copy")] * 900 + [("cold", "a"), ("cold", "b")]
    rows += [("lone", "z"), ("cold", None)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(partitions)
    found = text_by_group(df, ["k"], "v", ", ", min_rows=2, max_text=120).orderBy("k", "part").collect()
    whole = {}
    for r in found:
        assert len(r.text) <= 120 + len("copy, ") * 20
        whole.setdefault(r.k, []).append(r.text)
    joined = {k: ", ".join(v) for k, v in whole.items()}
    expected = {k: ", ".join(sorted(v for g, v in rows if g == k and v is not None)) for k in ("hot", "cold")}
    assert joined == expected
    assert {r.rows for r in found if r.k == "hot"} == {1300}
    assert [r.part for r in found if r.k == "hot"] == list(range(1, len(whole["hot"]) + 1))


@pytest.mark.parametrize("max_text", [1, 3, 64_000_000])
def test_both_ways_give_the_same_groups(spark, max_text):
    rows = [(None, "b"), (None, "a"), ("x", None), ("x", None), ("n", "q"), ("n", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, v string")
    found = {}
    for r in sorted(text_by_group(df, ["k"], "v", ",", max_text=max_text).collect(), key=lambda r: r.part):
        found.setdefault((r.k, r.rows), []).append(r.text)
    assert {k: ",".join(v) for k, v in found.items()} == {(None, 3): "a,b", ("x", 2): "", ("n", 2): "q"}


CELLS = [
    ("a", 1.5, "x"), (None, 1.5, "y"), (None, None, "long text"), ("abc", 1e9, "long text"), ("b", 1e9, None), ("c", -2.0, ""),
]


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(CELLS, "code string, amount double, note string").withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


def cell_checks():
    return {
        "required": integrity.required("code", "amount"),
        "code": integrity.not_longer("code", 2),
        "amount": integrity.in_range("amount", 7, 2),
        "note": integrity.not_longer("note", 4),
    }


def test_fused_column_checks_find_what_single_ones_find(cells):
    single = {
        "required": integrity.null_counts(cells, ["code", "amount"]),
        "code": integrity.too_long(cells, "code", 2),
        "amount": integrity.out_of_range(cells, "amount", 7, 2),
        "note": integrity.too_long(cells, "note", 4),
    }
    found = sorted(map(tuple, integrity.column_findings(cells, cell_checks()).collect()))
    assert found == sorted(map(tuple, integrity.violation_report(single).collect()))
    assert found == [
        ("amount", "1000000000.00", 2), ("code", "abc", 1), ("note", "long text", 2), ("required", "amount", 1), ("required", "code", 2),
    ]
    assert integrity.column_findings(cells.filter("false"), cell_checks()).count() == 0


def test_fused_column_checks_scan_once(spark):
    import contextlib
    import io

    import __spark_entry__ as spark_entry

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        spark_entry.queries()["integrity_report"](spark, "/root/testdata/sf0.001").explain("formatted")
    scans = [part for part in text.getvalue().split("\n\n") if "Scan parquet" in part and "lineitem" in part]
    assert sum("l_extendedprice" in part for part in scans) == 1  # the columns' checks
    assert sum("l_extendedprice" not in part for part in scans) == 1  # the key
