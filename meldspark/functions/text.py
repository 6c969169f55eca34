"""Text cleaning. Everything is a JVM expression; nothing here calls Python per row."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators (category Zs). Tabs and line ends are not among them.
SPACE_SEPARATORS = (
    " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)

# What ``str.split()`` cuts on: Unicode white space and the four ASCII information separators.
WORD_GAP = r"(?U)[\s\x1c-\x1f]+"

# What JSON escapes, character by character, which Java looks up in a table.
TO_ESCAPE = "[" + "".join(rf"\x{code:02x}" for code in (*range(0x20), ord('"'), ord("\\"))) + "]"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_spaces(text: Column | str) -> Column:
    """Strips every kind of space character, but no tabs or line ends, from both ends."""
    return F.trim(_col(text), F.lit(SPACE_SEPARATORS))


def blank_to_null(text: Column | str) -> Column:
    clean = trim_spaces(text)
    return F.when(clean != "", clean)


def lower_text(text: Column | str) -> Column:
    """Lower case letter by letter: no final-sigma rule, and dotted capital I becomes a plain i."""
    return F.lower(F.replace(F.replace(_col(text), F.lit("Σ"), F.lit("σ")), F.lit("İ"), F.lit("i")))


@lru_cache(maxsize=1)
def _stubborn_letters() -> dict[str, str]:
    """Letters whose full upper case is longer than one letter, with the single letter to use instead."""
    letters = [chr(c) for c in range(0x80, 0x20000) if not 0xD800 <= c <= 0xDFFF and len(chr(c).upper()) > 1]
    return {c: "ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in letters}


def upper_letter(letter: Column) -> Column:
    """Upper case of one letter that stays one letter (full case mapping may give two or three)."""
    single = _stubborn_letters()
    return F.when(
        letter.isin(list(single)), F.translate(letter, "".join(single), "".join(single.values()))
    ).otherwise(F.upper(letter))


def proper_case(text: Column | str) -> Column:
    """First letter of the trimmed text upper, all the rest lower; blank gives NULL."""
    clean = trim_spaces(text)
    first, rest = F.left(clean, F.lit(1)), F.substring(clean, 2, 2**31 - 1)
    plain = F.length(clean) == F.octet_length(clean)  # ASCII needs none of the rules for special letters
    return F.when(
        clean != "",
        F.when(plain, F.concat(F.upper(first), F.lower(rest))).otherwise(F.concat(upper_letter(first), lower_text(rest))),
    )


def title_case(text: Column | str) -> Column:
    """A capital after anything that is not a cased letter: "u.s.a." gives "U.S.A."."""
    cased = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
    runs = F.regexp_extract_all(_col(text), F.lit(f"[{cased}]+|[^{cased}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def spelling_key(text: Column | str) -> Column:
    """The form under which dictionary spellings are compared."""
    return lower_text(trim_spaces(text))


def full_name(first: Column | str, last: Column | str) -> Column:
    """NULL if either part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def words(text: Column | str) -> Column:
    """The words of a text as an array, without empty ones."""
    return F.filter(F.split(_col(text), WORD_GAP), lambda word: word != "")


def decimal_comma(text: Column | str) -> Column:
    return F.replace(_col(text), F.lit(","), F.lit("."))


def money_text(cents: Column | str, separator: str) -> Column:
    """Whole cents as text with two decimals: -5 gives "-0.05" or "-0,05". Any whole number up to 38 digits."""
    amount = _col(cents).cast("decimal(38,0)")
    digits = F.abs(amount).cast("string")
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(3)), F.lit("0"))
    whole = F.substring(digits, F.lit(1), F.length(digits) - 2)
    return F.concat(F.when(amount < 0, "-").otherwise(""), whole, F.lit(separator), F.right(digits, F.lit(2)))


def json_quoted(text: Column | str) -> Column:
    """A JSON string literal, which is also a double-quoted YAML scalar. NULL gives "null".

    Only texts with a character to escape go through the JSON writer, which costs many times the quotes.
    """
    value = _col(text)
    document = F.to_json(F.struct(value.alias("v")))
    escaped = F.substring(document, F.lit(6), F.length(document) - 6)
    quoted = F.when(value.rlike(TO_ESCAPE), escaped).otherwise(F.concat(F.lit('"'), value, F.lit('"')))
    return F.when(value.isNull(), F.lit("null")).otherwise(quoted)


@lru_cache(maxsize=1)
def _ascii_letters() -> tuple[str, str, str]:
    """Compatibility decompositions that leave ASCII letters or digits: one-to-one, and one-to-many as JSON."""
    single, several = {"ł": "l", "Ł": "L"}, {}
    for code in range(0x80, 0x20000):  # no later character decomposes to ASCII
        if not unicodedata.decomposition(chr(code)):
            continue
        kept = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if c.isascii() and c.isalnum())
        if len(kept) == 1:
            single[chr(code)] = kept
        elif kept:
            several[chr(code)] = kept
    return "".join(single), "".join(single.values()), json.dumps(several, ensure_ascii=False)


def ascii_fold(text: Column | str) -> Column:
    """Letters and digits without accents, lower case, everything else dropped."""
    singles, replacements, several = _ascii_letters()
    value = _col(text)
    expansions = F.from_json(F.lit(several), "map<string,string>")
    multi_letter = "[" + "".join(json.loads(several)) + "]"
    expanded = F.when(
        value.rlike(multi_letter),
        F.array_join(
            F.transform(F.split(value, ""), lambda c: F.coalesce(F.try_element_at(expansions, c), c)), ""
        ),
    ).otherwise(value)
    plain = F.when(F.length(value) == F.octet_length(value), value).otherwise(
        F.translate(expanded, singles, replacements)
    )
    return F.lower(F.regexp_replace(plain, "[^A-Za-z0-9]", ""))


def register_sql_functions(spark) -> None:
    """``blank_to_null`` and ``proper_case`` for use in SQL text of this session, by the rules of their column twins."""
    single = _stubborn_letters()
    letter = "left(blank_to_null(raw), 1)"
    listed = ", ".join(f"'{c}'" for c in single)
    upper = (
        f"CASE WHEN {letter} IN ({listed}) THEN translate({letter}, '{''.join(single)}', '{''.join(single.values())}') "
        f"ELSE upper({letter}) END"
    )
    lower = "lower(replace(replace(substr(blank_to_null(raw), 2), 'Σ', 'σ'), 'İ', 'i'))"
    bodies = {
        "blank_to_null": f"nullif(trim(BOTH '{SPACE_SEPARATORS}' FROM raw), '')",
        "proper_case": f"{upper} || {lower}",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(raw STRING) RETURNS STRING RETURN {body}")
