"""Quality rules by distribution divergence.

Every document has two histograms: its characters by class, and its words by the most common words of its language.
They are compared with the histograms of the whole language by the Jensen-Shannon distance (base 2, 0 to 1). A
document is rejected if a distance exceeds its threshold and it is long enough for that histogram; the threshold
of words is widened for short texts, whose histograms scatter. References come from all documents of the language; a
language with too few words has no reference, so nothing is held against its documents.

All steps are DataFrame expressions. Repeated five-word windows are found inside the row: window hashes are packed with
their place into one long and sorted as primitives, so copies stand side by side; nothing is exploded but short words for
the common-word counts, which are reduced per task before they are shuffled.

Defined cases: null, empty and blank texts have no words and fail the base rule; a null language is a language of its
own; equal rows and doc_ids are judged separately and equally; ties among common words go by the word; an empty
table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meldspark.session import broadcast_if_small, stage

BLANK = "\\x20\\x09-\\x0D"
WINDOW_WORDS = 5
MIN_WORDS, MAX_REPEATED = 10, 20
COMMON_WORDS, COMMON_CHARS = 16, 5
CLASSES = {
    "upper": "[A-Z]",
    "digit": "[0-9]",
    "mark": "[.,;:!?'\"()-]",
    "symbol": "[\\x21-\\x7E&&[^a-zA-Z0-9.,;:!?'\"()-]]",
    "beyond": "[^\\x00-\\x7F]",
}
LETTERS = "abcdefghijklmnop"
MIN_CHARS_JUDGED, MIN_WORDS_JUDGED, MIN_REFERENCE_WORDS = 200, 60, 5_000
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE, WORD_SCATTER = 0.30, 0.24, 1.6

# The cells of both histograms, in order.
CLASS_COLUMNS = [*(f"c_{name}" for name in CLASSES), "c_rest"]
WORD_COLUMNS = [*(f"w_{k}" for k in range(COMMON_WORDS)), "w_rest"]


def words(text: Column) -> Column:
    """Runs of characters that aren't blank."""
    trimmed = F.regexp_replace(text, f"^[{BLANK}]+|[{BLANK}]+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANK}]+"))


def base_features(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep``, then _lang, _t, _words and the base counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), t.alias("_t"))
    rows = rows.withColumn("_words", words(F.col("_t")))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    rows = rows.select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count("[#*$%&|<>]").alias("n_symbols"),
        lines.alias("_lines"),
        _window_hashes().alias("_windows"),
    )
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    rows = rows.withColumn("_bits", F.expr("cast(ceil(log2(size(_windows) + 1)) as int)"))
    rows = rows.withColumn("_packed", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.expr(PACKED)))
    rows = rows.withColumn("_places", F.expr(PLACES))
    return rows.withColumn("n_repeat_words", F.expr(COVERED)).drop("_lines", "_windows", "_bits", "_packed", "_places")


def _count(pattern: str) -> Column:
    """Characters of the text in a class."""
    return (F.size(F.split("_t", pattern, -1)) - 1).cast("long")


def _window_hashes() -> Column:
    """The hash of every window of five words; no window gives an empty array."""
    w = F.col("_words")
    last = F.size(w) - WINDOW_WORDS
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW_WORDS)]))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


# Upper bits of the hash, then the place in _bits bits: once sorted, equal windows are neighbours.
PACKED = "sort_array(transform(_windows, (h, i) -> shiftleft(shiftright(h, _bits), _bits) | cast(i as bigint)))"
_PLACE = "cast({0} & (shiftleft(1L, _bits) - 1) as int)"
_SAME = (
    "(shiftright(x, _bits) = shiftright({0}, _bits) AND get(_windows, "
    + _PLACE.format("x") + ") = get(_windows, " + _PLACE.format("{0}") + "))"
)
PLACES = (
    "sort_array(transform(filter(_packed, (x, j) -> "
    "CASE WHEN j > 0 AND " + _SAME.format("get(_packed, j - 1)") + " THEN true "
    "WHEN j + 1 < size(_packed) THEN " + _SAME.format("get(_packed, j + 1)") + " ELSE false END), "
    "x -> " + _PLACE.format("x") + "))"
)
COVERED = (
    "coalesce(aggregate(sequence(0, size(_places) - 1), 0L, (n, i) -> n + CASE WHEN i + 1 < size(_places) "
    f"THEN least({WINDOW_WORDS}, get(_places, i + 1) - get(_places, i)) ELSE {WINDOW_WORDS} END), 0L)"
)


def common_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_lang, _common): the most frequent words of at most ``COMMON_CHARS`` characters of every language."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), words(t).alias("_words"))
    short = F.filter("_words", lambda w: F.length(w) <= COMMON_CHARS)
    counted = rows.select("_lang", F.explode(short).alias("_word")).select("_lang", F.lower("_word").alias("_word"))
    counted = counted.groupBy("_lang", "_word").agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(W.partitionBy("_lang").orderBy(F.desc("_n"), "_word"))
    top = counted.withColumn("_place", place).filter(F.col("_place") <= COMMON_WORDS)
    listed = F.array_sort(F.collect_list(F.struct("_place", "_word")))
    return top.groupBy("_lang").agg(F.transform(listed, lambda x: x["_word"]).alias("_common"))


def histograms(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep``, _lang, base counts and both histograms (_classes, _common) of every row, written once."""
    common = stage(common_words(docs, text), "common-words")
    rows = base_features(docs, keep, text).join(broadcast_if_small(common), "_lang", "left")
    letter = f"get(split('{LETTERS}', ''), cast(array_position(_common, lower(w)) as int) - 1)"
    spelled = F.expr(f"array_join(transform(filter(_words, w -> length(w) <= {COMMON_CHARS}), w -> {letter}), '')")
    rows = rows.withColumn("_spelled", F.coalesce(spelled, F.lit("")))
    classes = F.array(*[_count(pattern) for pattern in CLASSES.values()])
    taken = F.array(*[(F.length("_spelled") - F.length(F.replace("_spelled", F.lit(x)))).cast("long") for x in LETTERS])
    rows = rows.withColumns({"_classes": classes, "_common": taken})
    rest = F.col("word_chars") - F.aggregate("_classes", F.lit(0).cast("long"), lambda n, x: n + x)
    rows = rows.withColumns(
        {
            "_classes": F.concat("_classes", F.array(rest)),
            "_common": F.concat("_common", F.array(F.col("n_words") - F.length("_spelled"))),
        }
    )
    return stage(rows.drop("_t", "_words", "_spelled"), "histograms")


def language_references(rows: DataFrame) -> DataFrame:
    """(_lang, _class_share, _word_share, _reference_words): the histograms of whole languages, as shares."""
    sums = {
        name: F.array(*[F.sum(F.get(name, F.lit(k))) for k in range(cells)])
        for name, cells in (("_classes", len(CLASS_COLUMNS)), ("_common", len(WORD_COLUMNS)))
    }
    total = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda n, x: n + x)
    totals = rows.groupBy("_lang").agg(*[c.alias(name) for name, c in sums.items()])
    totals = totals.withColumns({"_chars": total("_classes"), "_reference_words": total("_common")})
    return totals.select(
        "_lang",
        F.transform("_classes", lambda x: x / F.greatest(F.col("_chars"), F.lit(1))).alias("_class_share"),
        F.transform("_common", lambda x: x / F.greatest(F.col("_reference_words"), F.lit(1))).alias("_word_share"),
        "_reference_words",
    )


def _distance(counts: str, total: str, reference: str) -> Column:
    """Jensen-Shannon distance of a row's histogram and its language's shares."""

    def cell(p: Column, q: Column) -> Column:
        part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))
        return part(p, q) + part(q, p)

    own = F.transform(counts, lambda n: n / F.col(total))
    divergence = F.aggregate(F.zip_with(own, reference, cell), F.lit(0.0), lambda sum, x: sum + x) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def judged(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, base counts, base_failed, kept and both distances (null: not judged)."""
    rows = histograms(docs, keep, text)
    rows = rows.join(broadcast_if_small(stage(language_references(rows), "language-references")), "_lang", "left")
    known = F.col("_reference_words") >= MIN_REFERENCE_WORDS
    by_class = F.when(known & (F.col("word_chars") >= MIN_CHARS_JUDGED), _distance("_classes", "word_chars", "_class_share"))
    by_word = F.when(known & (F.col("n_words") >= MIN_WORDS_JUDGED), _distance("_common", "n_words", "_word_share"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, "class_distance": by_class, "word_distance": by_word})
    scatter = MAX_WORD_DISTANCE + WORD_SCATTER / F.sqrt(F.greatest("n_words", F.lit(1)))
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= scatter
    )
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    distances = [F.round(name, 6).alias(name) for name in ("class_distance", "word_distance")]
    return rows.select(*keep, *base, (~F.col("base_failed") & fits).alias("kept"), *distances)


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with the base counts, the verdict and both distances."""
    return judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text"))


def keep_good(docs: DataFrame) -> DataFrame:
    """All columns of the documents that the rules keep."""
    packed = docs.select(F.struct("*").alias("row"), "lang", "text")
    return judged(packed, ("row",)).filter("kept").select("row.*")
