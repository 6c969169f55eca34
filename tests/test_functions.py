"""Column functions against DuckDB's and Python's own."""

import json
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from meldspark.functions import parse, text
from meldspark.functions.classify import income_bracket, ratio_class

DOTTED = [
    "1.2.1990", "01.02.1990", " 01.02.1990 ", "\t01.02.1990", "01.02.1990\n", "01.02.90", "01.02.990", "31.02.1990",
    "29.02.1900", "29.02.2000", "00.00.0000", "unknown", "", "n/a", "1990-02-31", "01.02.19900", "1.2.1990x",
    "1 .2.1990", "001.02.1990", "1.13.1990", "32.1.1990", "1.2.-990", "+1.2.1990", " 1.2.1990",
    "1.2.1990 00:00:00", "٠١.02.1990", "01..1990", "1.2.9999", "1.2.0001", None,
]
ISO = ["1990-1-2", "1990-01-02", " 1990-01-02 ", "90-01-02", "1990-02-30", "1990/01/02", "1990-01-02T00:00",
       "19900-01-02", "-990-01-02", "1990-01-2x", "1990- 01-02", None]
TIMES = ["2020-01-02 03:04:05", "2020-1-2 3:4:5", " 2020-01-02 03:04:05 ", "2020-01-02  03:04:05",
         "2020-01-02 24:00:00", "2020-01-02 03:04", "2020-01-02 03:04:60", "2020-01-02 03:04:05.5",
         "2020-01-02T03:04:05Z", "20-01-02 03:04:05", "2020-02-30 03:04:05", "2020-01-02\t03:04:05",
         "2020-01-0203:04:05", "2020-1-203:04:05", "9999-12-31 23:59:59", "2020-01-02 23:60:00", "20-1-2  3:4:5",
         "2020-1-2T3:4:5Z", "2020-01-02T03:04:05 Z", "2020-01-02T03:04:05z", "2020-01-02t03:04:05Z", "20-1-2T3:4:5Z",
         "2020-01-02T03:04:05ZZ", None]
MONEY = ["12.5", "12.345", "12.344", "-12.345", "12.34.56", "N/A", "", "unknown", "1e3", "1E3", "1e-1", " 5 ", "\t5",
         "+5", ".5", "5.", "-.5", ".", "1_000", "1,000", "inf", "nan", "9999999999.99", "9999999999.994",
         "9999999999.995", "99999999999", "0x1F", "1e400", "1e9", "1e10", "-0.001", "--5", "5-", "٥", "5 000", "5f",
         "1e", "1e+2", "0.005", "-0.005", "1__0", "_1", "1_", "1.5_5", None]
WHOLE = ["5", "+5", "-5", " 5 ", "\t5", "12.5", "-12.5", "12.4999999", "12.49999999999999999999", "0.5", "-0.5", "1e3",
         "1.5e1", "1_000", "0x1F", "0X1f", "0b101", "9223372036854775807", "9223372036854775808",
         "9223372036854775807.4", "9223372036854775807.5", "-9223372036854775808", "-9223372036854775809", "abc", "",
         "5.", "  ", ".5", "5L", "1e400", "1e18", "1e19", "00005", "--5", "1e-1", "+", "-", "1 2", "1__0", "5.0_1",
         "0xFFFFFFFFFFFFFFFF", "0x", "2.5", "3.5", None]
FLAGS = ["true", "TRUE", "tRue", "t", "T", "f", "F", "false", "yes", "YES", "y", "Y", "n", "no", "1", "0", "on", "off",
         " true", "true ", "\ttrue", "2", "", "maybe", "1.0", None]


def duck(values, expression):
    rows = duckdb.connect().execute(
        f"SELECT i, CAST({expression} AS VARCHAR) FROM (SELECT unnest(?) AS i, unnest(?) AS t) ORDER BY i",
        [list(range(len(values))), values],
    ).fetchall()
    return [row[1] for row in rows]


@pytest.mark.parametrize(
    "values, column, expression",
    [
        (DOTTED, lambda: parse.parse_date("t", parse.DAY_DOTTED), "try_strptime(t, '%d.%m.%Y')::DATE"),
        (ISO, lambda: parse.parse_date("t", parse.ISO_DAY), "try_strptime(t, '%Y-%m-%d')::DATE"),
        ([t and t.replace("-", "/") for t in ISO], lambda: parse.parse_date("t", parse.SLASHED_DAY),
         "try_strptime(t, '%Y/%m/%d')::DATE"),
        (TIMES, lambda: parse.parse_timestamp("t", parse.SPACED_TIME), "try_strptime(t, '%Y-%m-%d %H:%M:%S')"),
        (TIMES, lambda: parse.parse_timestamp("t", parse.ZULU_TIME), "try_strptime(t, '%Y-%m-%dT%H:%M:%SZ')"),
        (MONEY, lambda: parse.parse_decimal("t"), "TRY_CAST(trim(t) AS DECIMAL(12, 2))"),
        (MONEY, lambda: parse.parse_decimal("t", comma=True), "TRY_CAST(translate(trim(t), ',', '.') AS DECIMAL(12, 2))"),
        (WHOLE, lambda: parse.parse_whole_number("t"), "TRY_CAST(trim(t) AS BIGINT)"),
        (FLAGS, lambda: parse.parse_boolean("t"), "TRY_CAST(t AS BOOLEAN)"),
    ],
    ids=["dotted", "iso", "slashed", "spaced", "zulu", "money", "comma", "whole", "boolean"],
)
def test_parsing_agrees(texts, values, column, expression):
    found = dict(zip(values, texts(values, column().cast("string"))))
    assert found == dict(zip(values, duck(values, expression)))


def test_flags(texts):
    values = ["Y", " n ", "y", "X", "", None, "yes"]
    assert texts(values, parse.parse_flag("t", "Y", "N")) == [True, False, True, None, None, None, None]


PADS = [f"{s}ab{s}" for s in "       　\t\n\x0b\x85​  "] + ["", "  ", None]
NAMES = ["  jean PAUL ", "ßa", "éa", "İSTANBUL", "", "  ", None, "ﬁNN", "o'NEILL", "ΑΣ", "ŉa", "ǆ", "ᾀΣ", "anna-MARIA"]


def test_trimming_and_case_agree(texts):
    assert texts(PADS, text.trim_spaces("t")) == duck(PADS, "trim(t)")
    assert texts(PADS, text.blank_to_null("t")) == duck(PADS, "nullif(trim(t), '')")
    proper = "upper(left(nullif(trim(t), ''), 1)) || lower(substr(nullif(trim(t), ''), 2))"
    assert texts(NAMES, text.proper_case("t")) == duck(NAMES, proper)
    assert texts(NAMES, text.lower_text("t")) == duck(NAMES, "lower(t)")


def test_every_latin_and_greek_letter_has_one_upper_letter(texts):
    letters = [chr(c) for c in range(0x41, 0x590) if chr(c).isalpha() and c not in (0x19B, 0x264)]
    assert texts(letters, text.upper_letter(F.col("t"))) == duck(letters, "upper(t)")


def fold(value):
    plain = unicodedata.normalize("NFKD", value.translate(str.maketrans("łŁ", "lL")))
    return "".join(c for c in plain if c.isascii() and c.isalnum()).lower()


def test_ascii_fold_over_all_characters(texts):
    values = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    values += ["Łukasz Wiśniewski", "Straße", "ﬁn ½", "O'Neill", "㎏ Ǆ", ""]
    assert texts(values, text.ascii_fold("t")) == [fold(v) for v in values]


def test_title_case_like_python(texts):
    values = ["u.s.a.", "o'neill mcx", "GREAT britain", "él ñu", "a1b", "", "república česká", "it's 3rd", "日本a b"]
    assert texts(values, text.title_case("t")) == [v.title() for v in values]


def test_words_like_python(texts):
    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    values = ["a" + "a".join(spaces) + "b" + spaces + "c ", "", "   ", "one"]
    assert texts(values, text.words("t")) == [v.split() for v in values]


def test_json_quoting(texts):
    values = ['a"b\\c\n\t\x01é/', "", "x y"]
    assert texts(values, text.json_quoted("t")) == [json.dumps(v, ensure_ascii=False) for v in values]


def test_money_text(spark):
    cents = spark.createDataFrame([(c,) for c in (0, 5, -5, 123456, -100)], "c long")
    assert [r[0] for r in cents.select(text.money_text("c", ",")).collect()] == [
        "0,00", "0,05", "-0,05", "1234,56", "-1,00"
    ]
    wide = spark.sql("SELECT -9223372036854775808 AS c UNION ALL SELECT CAST(10 AS DECIMAL(38,0)) * 1000000000000000000000")
    assert [r[0] for r in wide.select(text.money_text("c", ".")).collect()] == [
        "-92233720368547758.08", "100000000000000000000.00"
    ]


def test_sql_functions(spark):
    text.register_sql_functions(spark)
    names = spark.createDataFrame([(n,) for n in ("ßeta", "İZMİR", "ΟΔΟΣ", "ǆur", " ŉx ", "x", "", None)], "n string")
    twins = names.select(text.proper_case("n").alias("a"), F.expr("proper_case(n)").alias("b")).collect()
    assert all(r.a == r.b for r in twins) and twins[0].a == "ẞeta"
    row = spark.sql("SELECT proper_case('  jean PAUL ') a, blank_to_null('  ') b, proper_case(' ') c").first()
    assert tuple(row) == ("Jean paul", None, None)


@pytest.mark.parametrize(
    "income, bracket",
    [("0.00", "low"), ("19999.99", "low"), ("20000.00", "mid"), ("99999.99", "mid"), ("100000.00", "high"),
     (None, "high")],
)
def test_income_boundaries(texts, income, bracket):
    assert texts([income], income_bracket(F.col("t").cast("decimal(12,2)"))) == [bracket]


def test_rounded_and_exact_ratio_differ_at_the_edge(spark):
    df = spark.createDataFrame([(506, 102)], "gdp int, population int")
    classes = df.select(
        ratio_class(F.col("gdp"), F.col("population"), True), ratio_class(F.col("gdp"), F.col("population"), False)
    )
    assert tuple(classes.first()) == ("middle", "poor")
