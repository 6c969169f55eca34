"""Personal data: base patterns, then information-theoretic sanitisation of terms that reveal them.

Base spans (emails, addresses, cards, phones) are protected entities. Their neighbours, the words within
``CONTEXT_CHARS`` characters, are candidate terms. From the whole corpus come, for every entity e and term t, the
distinct texts with both, with t and with e, wherever they stand in the text; the pointwise mutual information of t and
e, as a share of the information content of e, says how far t alone reveals e. Terms whose share reaches ``DISCLOSURE``
are spans of kind ``term`` in every text and at every place, beside e or not, and are generalised like the entity itself.

A single text says nothing about its words: each rare one of them would reveal e. A second, independent text is needed,
and is enough: by chance it has t only with the small share of texts that have t. Texts with the same surroundings of e
(the same set of them, where e stands several times) are not independent, so copies and near copies are one piece of evidence.

All steps are DataFrame expressions. A text is cut at the matches of a pattern (the same scan that extracts them),
so places follow from lengths; patterns are anchored at run starts and possessive, so no text makes them
backtrack over a run again and again. Running totals of the lengths go by blocks, and a text is put together again from
blocks of it, so a text of a hundred thousand matches takes seconds. Only entities and terms are shuffled; texts move only if
more rows than can be broadcast have a term to be marked.

Defined cases: null text counts as empty and has no spans; equal rows get equal spans, copies counting as one text;
equal doc_ids are separate rows; spans that overlap or tie are all kept, sorted by kind, start and end; an empty table gives an
empty result; extra columns are left alone, whatever their names. Very long texts: memory follows the longest text and its
matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldspark.session import broadcast_if_small, stage

KINDS = ("email", "ip", "card", "phone")
# Matches equal those of the plain patterns: a run is entered at its start or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "ip": ".", "phone": "+"}
CONTEXT_CHARS = 60
BLOCK_CHARS = 1024
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
INDEPENDENT, DISCLOSURE = 2, 0.9

MATCH = "array<struct<start:int,stop:int,value:string,before:string,after:string>>"
OCCURRENCE = "array<struct<entity:string,term:string,context:bigint,start:int,stop:int>>"
PLACE = "array<struct<start:int,stop:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in there."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For every place of an array of integers, ``join`` (associative, zero neutral) of all values before it.

    Lists grow by copying, so they are kept short: blocks of about the cube root of the size, then the blocks' own totals.
    """
    none = F.array().cast("array<int>")

    def before(items: Column) -> Column:
        state = F.struct(F.lit(0).alias("at"), none.alias("list"))

        def step(state: Column, item: Column) -> Column:
            return F.struct(join(state["at"], item).alias("at"), F.concat(state["list"], F.array(state["at"])).alias("list"))

        return F.aggregate(items, state, step, lambda state: state["list"])

    def by_blocks(v: Column) -> Column:
        width = F.greatest(F.lit(16), F.ceil(F.cbrt(F.size(v))).cast("int"))
        blocks = _let(
            width,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.floor((F.size(v) - 1) / w).cast("int")), lambda b: F.slice(v, b * w + 1, w)
            ),
        )

        def joined(parts: Column) -> Column:
            totals = F.transform(parts, lambda items: F.aggregate(items, F.lit(0), join))
            inside = F.transform(parts, before)
            return F.flatten(F.zip_with(inside, before(totals), lambda items, base: F.transform(items, lambda x: join(base, x))))

        return F.when(F.size(v) > 0, _let(blocks, joined)).otherwise(none)

    return _let(values, by_blocks)


def _matches(text: Column, pattern: str) -> Column:
    """Start, end (code points), text and both neighbourhoods of every match, in order.

    Neighbourhoods come from the pieces between matches, so each piece is looked at twice, however long the text is.
    """
    found, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(both: Column) -> Column:
        lengths = F.transform(both, lambda one: F.length(one["piece"]) + F.length(one["value"]))

        def match(one: Column, before: Column) -> Column:
            start = before + F.length(one["piece"])
            return F.struct(
                start.alias("start"),
                (start + F.length(one["value"])).alias("stop"),
                one["value"].alias("value"),
                F.right(one["piece"], F.lit(CONTEXT_CHARS)).alias("before"),
                F.left(one["next"], F.lit(CONTEXT_CHARS)).alias("after"),
            )

        return F.zip_with(both, _running(lengths, lambda a, b: a + b), match)

    def zipped(values: Column) -> Column:
        return _let(
            pieces,
            lambda p: F.arrays_zip(
                values.alias("value"),
                F.slice(p, 1, F.size(values)).alias("piece"),
                F.slice(p, 2, F.size(values)).alias("next"),
            ),
        )

    return _let(_let(found, zipped), placed).cast(MATCH)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":

        def small(part: Column) -> Column:
            digits = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(digits) > 3, False).otherwise((F.concat(F.lit("0"), digits)).cast("int") <= 255)

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))

        def step(total: Column, place: Column) -> Column:
            digit = F.substring(digits, place + 1, F.lit(1)).cast("int")
            doubled = 2 * digit - F.when(digit > 4, 9).otherwise(0)
            return total + F.when(place % 2 == 1, doubled).otherwise(digit)

        luhn = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0
        return F.when(F.length(digits).between(16, 19), luhn).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def base_matches(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep``, _t and one array of matches for each kind."""
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    none = F.array().cast(MATCH)
    for kind in KINDS:
        pattern = PATTERNS[kind]
        possible = F.col("_t").rlike(pattern)
        if kind in NEEDED:
            possible = F.contains("_t", F.lit(NEEDED[kind])) & possible
        rows = rows.withColumn(f"_{kind}", F.when(possible, _matches(F.col("_t"), pattern)).otherwise(none))
        rows = rows.withColumn(f"_{kind}", F.filter(f"_{kind}", lambda m: _valid(kind, m["value"])))
    return rows


def _entities() -> Column:
    """All base matches of a row as entities with the text on both sides."""

    def entity(kind: str, match: Column) -> Column:
        return F.struct(
            F.concat(F.lit(f"{kind}:"), F.lower(match["value"])).alias("entity"),
            F.xxhash64(match["before"], match["after"]).alias("context"),
            F.array(
                F.struct((match["start"] - F.length(match["before"])).alias("at"), match["before"].alias("t"), F.lit(0).alias("cut")),
                F.struct(match["stop"].alias("at"), match["after"].alias("t"), F.lit(1).alias("cut")),
            ).alias("sides"),
        )

    return F.concat(*[F.transform(f"_{kind}", lambda m: entity(kind, m)) for kind in KINDS])


def _occurrences() -> Column:
    """Terms beside every entity of a row. A word that may be cut off at the far end of the context is left out."""

    def terms(entity: Column, side: Column) -> Column:
        full = F.length(side["t"]) == CONTEXT_CHARS
        at_far_end = lambda m: F.when(side["cut"] == 0, m["start"] == 0).otherwise(m["stop"] == CONTEXT_CHARS)
        whole = F.filter(_matches(side["t"], TERM), lambda m: ~(full & at_far_end(m)))
        return F.transform(
            whole,
            lambda m: F.struct(
                entity["entity"].alias("entity"),
                F.lower(m["value"]).alias("term"),
                entity["context"].alias("context"),
                (side["at"] + m["start"]).alias("start"),
                (side["at"] + m["stop"]).alias("stop"),
            ),
        )

    beside = F.transform("_entities", lambda e: F.flatten(F.transform(e["sides"], lambda side: terms(e, side))))
    return F.flatten(beside).cast(OCCURRENCE)


def found_rows(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """Columns ``keep``, a row number, base matches, entities and term occurrences beside them, written once."""
    rows = base_matches(docs, keep, text).withColumn("_entities", _entities())
    rows = rows.withColumn("_near", F.when(F.size("_entities") > 0, _occurrences()).otherwise(F.array().cast(OCCURRENCE)))
    places = {f"_{kind}": F.transform(f"_{kind}", lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop"))) for kind in KINDS}
    rows = rows.withColumn("_named", F.transform("_entities", lambda e: e.dropFields("sides")))
    rows = rows.withColumns(places).withColumn("_hash", F.xxhash64("_t")).drop("_t", "_entities")
    return stage(rows.withColumn("_uid", F.monotonically_increasing_id()), "pii-rows")


def _words(rows: DataFrame, source: str, terms: DataFrame) -> DataFrame:
    """(_uid, _hash, term): which of ``terms`` stand in which row."""
    own = F.transform(F.regexp_extract_all(F.col(source), F.lit(TERM), F.lit(0)), lambda w: F.lower(w))
    beside = F.transform("_near", lambda o: o["term"])
    own = F.array_union(F.coalesce(own, F.array().cast("array<string>")), beside)
    return rows.select("_uid", "_hash", F.explode(own).alias("term")).join(broadcast_if_small(terms), "term", "left_semi")


def revealing_terms(rows: DataFrame, source: str) -> DataFrame:
    """(_uid, term): the rows of every term that reveals an entity; ``source`` is the text in ``rows``.

    Texts with both are at most those with the term and those with the entity. Pairs that can't reach the threshold
    with that are out twice: with the texts where the term stands beside entities, before the corpus is searched,
    and with all its texts, before rows are listed. That leaves no common word to be counted or listed there.
    """
    beside = rows.filter(F.size("_near") > 0).select("_hash", F.explode("_near").alias("o")).select("_hash", "o.*")
    named = rows.filter(F.size("_named") > 0).select("_hash", F.explode("_named").alias("e")).select("_hash", "e.*")
    # All surroundings of an entity in a text, in one number whatever their order: a text that shares some of them with
    # another text and has others too is evidence of its own.
    present = named.distinct().groupBy("_hash", "entity").agg(F.bit_xor("context").alias("context"))
    present = stage(present, "pii-present")
    independent = F.count_distinct("context") >= INDEPENDENT
    entities = present.groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity"), independent.alias("_enough"))
    entities = entities.filter("_enough").drop("_enough")
    pairs = beside.select("entity", "term").distinct()
    near = beside.groupBy("term").agg(F.count_distinct("_hash").alias("near"))
    total = F.lit(float(rows.select("_hash").distinct().count()))
    information = F.log2(total / F.col("with_entity"))

    def discloses(both: Column, with_term: str) -> Column:
        mutual = F.log2(total * both / (F.col(with_term) * F.col("with_entity")))
        return (information > 0) & (mutual >= DISCLOSURE * information)

    def possible(with_term: str) -> Column:
        return discloses(F.least(with_term, "with_entity"), with_term)

    pairs = stage(pairs.join(entities, "entity").join(near, "term").filter(possible("near")), "pii-pairs")
    found = _words(rows, source, stage(pairs.select("term").distinct(), "pii-terms"))
    with_term = found.groupBy("term").agg(F.count_distinct("_hash").alias("with_term"))
    with_term = with_term.filter(F.col("with_term") >= INDEPENDENT)
    pairs = stage(pairs.join(with_term, "term").filter(possible("with_term")), "pii-possible")
    listed = stage(_words(rows, source, pairs.select("term").distinct()), "pii-listed")
    texts = listed.select("_hash", "term").distinct()
    together = present.join(broadcast_if_small(pairs.select("entity", "term")), "entity").join(texts, ["_hash", "term"])
    both = together.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"), independent.alias("_enough"))
    both = both.filter("_enough")
    disclosing = pairs.join(both, ["entity", "term"]).filter(discloses(F.col("both"), "with_term"))
    terms = stage(disclosing.select("term").distinct(), "pii-disclosing")
    return listed.select("_uid", "term").join(broadcast_if_small(terms), "term", "left_semi")


def _places(text: Column) -> Column:
    """Start and end of every place of the terms ``_hit`` in a text."""
    hits = F.filter(_matches(text, TERM), lambda m: F.array_contains("_hit", F.lower(m["value"])))
    return F.transform(hits, lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("stop")))


def _sorted_distinct(values: Column) -> Column:
    return _let(F.array_sort(values), lambda v: F.filter(v, lambda x, i: (i == 0) | (x != F.get(v, i - 1))))


def spans_of(docs: DataFrame, keep: tuple[str, ...], source: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, one array of matches for each kind, and _terms: all places of revealing terms.

    ``source`` is the text among the columns ``keep``.
    """
    rows = found_rows(docs, keep, text)
    hits = revealing_terms(rows, source).groupBy("_uid").agg(F.collect_list("term").alias("_hit"))
    rows = rows.join(broadcast_if_small(stage(hits, "pii-hits")), "_uid", "left")
    beside = F.filter("_near", lambda o: F.array_contains("_hit", o["term"]))
    beside = F.transform(beside, lambda o: F.struct(o["start"].alias("start"), o["stop"].alias("stop")))
    every = _sorted_distinct(F.concat(_places(F.coalesce(F.col(source), F.lit(""))), beside))
    terms = F.when(F.col("_hit").isNotNull(), every).otherwise(F.array().cast(PLACE))
    return rows.withColumn("_terms", terms).drop("_near", "_named", "_hash", "_hit", "_uid")


def _listed(kind: str, column: str) -> Column:
    return F.transform(column, lambda m: F.concat_ws(":", F.lit(kind), m["start"], m["stop"]))


def pii_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row."""
    rows = spans_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ("doc_id", "text"), "text")
    base = [_listed(kind, f"_{kind}") for kind in KINDS]
    return rows.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(F.concat(*base), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*base, _listed("term", "_terms")), ",").alias("spans"),
        F.size("_terms").cast("long").alias("n_term"),
    )


def _text_between(blocks: Column, start: Column, stop: Column) -> Column:
    """The characters from ``start`` to before ``stop`` of a text in blocks of ``BLOCK_CHARS``; touches only those blocks."""
    first, last = (F.floor(x / BLOCK_CHARS).cast("int") for x in (start, stop))
    offset = start - first * BLOCK_CHARS
    inside = F.substring(F.get(blocks, first), offset + 1, stop - start)
    head = F.substring(F.get(blocks, first), offset + 1, F.lit(BLOCK_CHARS))
    between = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    tail = F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), stop - last * BLOCK_CHARS)
    return F.when(stop <= start, "").when(first == last, inside).otherwise(F.concat(head, between, tail))


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns; spans in ``text`` are replaced by their kind, ``n_chars`` follows where it is there.

    Spans that overlap are replaced together, by the kind of the first.
    """
    names = docs.columns
    packed = docs.select(F.struct("*").alias("row"), F.col(text))
    rows = spans_of(packed, ("row",), f"row.{text}", text)
    marked = F.array_sort(
        F.concat(
            *[F.transform(f"_{kind}", lambda m: F.struct(m["start"].alias("start"), (-m["stop"]).alias("back"), F.lit(f"[{kind.upper()}]").alias("mark"))) for kind in KINDS],
            F.transform("_terms", lambda m: F.struct(m["start"].alias("start"), (-m["stop"]).alias("back"), F.lit("[TERM]").alias("mark"))),
        )
    )
    source = F.col(f"row.{text}")
    blocks = F.regexp_extract_all(source, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    rows = rows.withColumn("_marked", marked).withColumn("_blocks", F.when(F.size("_marked") > 0, blocks))
    rows = rows.withColumn("_reached", _running(F.transform("_marked", lambda m: -m["back"]), lambda a, b: F.greatest(a, b)))

    def piece(span: Column, reached: Column) -> Column:
        """What a span adds: the text since the spans before it and its mark, or nothing if it overlaps with them."""
        added = F.concat(_text_between(F.col("_blocks"), reached, span["start"]), span["mark"])
        return F.when(span["start"] >= reached, added).otherwise("")

    end = F.array_max(F.transform("_marked", lambda m: -m["back"]))
    pieces = F.concat(F.zip_with("_marked", "_reached", piece), F.array(_text_between(F.col("_blocks"), end, F.length(source))))
    rebuilt = F.array_join(pieces, "")
    rows = rows.withColumn("_new", F.when(F.size("_marked") > 0, rebuilt).otherwise(source))
    changed = {text: F.col("_new")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.size("_marked") > 0, F.length("_new").cast(kind)).otherwise(F.col("row.n_chars"))
    return rows.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in names])
