"""DuckDB SQL that must give the same rows as the registered queries."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS u, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT item_id, w, least(len(w), 10) AS m FROM items WHERE len(w) > 0),
starts AS (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM sized),
wanted AS (SELECT DISTINCT item_id, m, array_to_string(w[s:s + m - 1], ' ') AS k FROM starts),
widths AS (SELECT DISTINCT m FROM wanted),
places AS (SELECT u, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM docs, widths WHERE len(w) >= m),
windows AS (SELECT u, m, s, array_to_string(w[s:s + m - 1], ' ') AS k FROM places),
hits AS (SELECT u, windows.m AS m, s, item_id FROM windows JOIN wanted USING (m, k)),
covered AS (SELECT u, unnest(range(s, s + m)) AS p FROM hits),
counted AS (SELECT u, count(DISTINCT p) AS n_hit FROM covered GROUP BY u),
numbered AS (SELECT u, p, p - row_number() OVER (PARTITION BY u ORDER BY p) AS g FROM (SELECT DISTINCT u, p FROM covered)),
stretches AS (SELECT u, min(p) - 1 AS a, count(*) AS n FROM numbered GROUP BY u, g),
placed AS (SELECT u, string_agg(a || ':' || n, ',' ORDER BY a) AS hit_spans FROM stretches GROUP BY u),
named AS (SELECT u, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
          FROM (SELECT DISTINCT u, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY u)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(hit_spans, '') AS hit_spans
FROM docs LEFT JOIN counted USING (u) LEFT JOIN placed USING (u) LEFT JOIN named USING (u)
"""


def quality_sql() -> str:
    """The quality rules with the parameters of their module."""
    from meldspark.llm import op04_quality as op

    counted = {
        "c_upper": "[A-Z]",
        "c_digit": "[0-9]",
        "c_mark": "[.,;:!?''\"()-]",
        "c_symbol": "[#$%&*+/<=>@\\[\\\\\\]^_`{|}~]",
        "c_beyond": "[^\\x00-\\x7F]",
    }
    classes = ", ".join(f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) AS {n}" for n, p in counted.items())
    common = ", ".join(f"count(*) FILTER (place = {k + 1}) AS w_{k}" for k in range(op.COMMON_WORDS))
    counts = ", ".join(f"coalesce(w_{k}, 0) AS w_{k}" for k in range(op.COMMON_WORDS))
    taken = " + ".join(f"coalesce(w_{k}, 0)" for k in range(op.COMMON_WORDS))
    sums = ", ".join(f"sum({n}) AS r_{n}" for n in op.CLASS_COLUMNS + op.WORD_COLUMNS)

    def distance(names: list[str], own: str) -> str:
        total = "(" + " + ".join(f"r_{n}" for n in names) + ")"
        parts = []
        for n in names:
            p, q = f"({n} / {own}::DOUBLE)", f"(r_{n} / {total}::DOUBLE)"
            parts += [f"CASE WHEN {a} > 0 THEN {a} * log2({a} / (({p} + {q}) / 2)) ELSE 0 END" for a in (p, q)]
        return "sqrt(greatest((" + " + ".join(parts) + ") / 2, 0))"

    known = "(" + " + ".join(f"r_{n}" for n in op.WORD_COLUMNS) + f") >= {op.MIN_REFERENCE_WORDS}"
    n = op.WINDOW_WORDS
    return f"""
WITH docs AS (SELECT row_number() OVER () AS u, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM docs),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM split),
starts AS (SELECT u, w, unnest(range(1, len(w) - {n - 2})) AS s FROM split),
windows AS (SELECT u, s, array_to_string(w[s:s + {n - 1}], ' ') AS k FROM starts),
repeated AS (SELECT u, s FROM windows QUALIFY count(*) OVER (PARTITION BY u, k) > 1),
covered AS (SELECT u, count(DISTINCT p) AS n_repeat_words FROM (SELECT u, unnest(range(s, s + {n})) AS p FROM repeated) GROUP BY u),
short AS (SELECT u, lang, lower(x) AS x FROM (SELECT u, lang, unnest(w) AS x FROM split) WHERE length(x) <= {op.COMMON_CHARS}),
ranked AS (SELECT lang, x, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, x) AS place FROM short GROUP BY lang, x),
found AS (SELECT u, {common} FROM short JOIN ranked USING (lang, x) WHERE place <= {op.COMMON_WORDS} GROUP BY u),
sized AS (SELECT u, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, {classes} FROM lined),
counted AS (SELECT * EXCLUDE (w_0), word_chars - c_upper - c_digit - c_mark - c_symbol - c_beyond AS c_rest FROM
  (SELECT sized.*, coalesce(n_repeat_words, 0) AS n_repeat_words, 0 AS w_0 FROM sized LEFT JOIN covered USING (u))),
histograms AS (SELECT c.*, {counts}, n_words - ({taken}) AS w_rest FROM counted c LEFT JOIN found USING (u)),
languages AS (SELECT lang, {sums} FROM histograms GROUP BY lang),
measured AS (SELECT *, n_words < {op.MIN_WORDS} OR 100 * n_repeat_words > {op.MAX_REPEATED} * n_words AS base_failed,
  CASE WHEN {known} AND word_chars >= {op.MIN_CHARS_JUDGED} THEN {distance(op.CLASS_COLUMNS, 'word_chars')} END AS by_class,
  CASE WHEN {known} AND n_words >= {op.MIN_WORDS_JUDGED} THEN {distance(op.WORD_COLUMNS, 'n_words')} END AS by_word
  FROM histograms JOIN languages USING (lang))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(by_class, 0) <= {op.MAX_CLASS_DISTANCE}
    AND coalesce(by_word, 0) <= {op.MAX_WORD_DISTANCE} + {op.WORD_SCATTER} / sqrt(greatest(n_words, 1)) AS kept,
  round(by_class, 6) AS class_distance, round(by_word, 6) AS word_distance
FROM measured
"""


# crc32 of a decimal number, bit by bit; 3988292384 is the reversed polynomial.
CRC32 = """
xor(list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT),
    lambda crc, byte: list_reduce(
        [xor(crc, byte)] || list_transform(range(8), lambda i: 0::BIGINT),
        lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
    )
), 4294967295::BIGINT)
"""

CONVERSATION_TRIE = f"""
WITH turns AS (
    SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
        substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
    SELECT conv_id AS c, list({{'digest': digest, 'size': size}} ORDER BY turn NULLS FIRST, digest) AS turns FROM turns GROUP BY conv_id
),
lengths AS (SELECT c, turns, {CRC32} % 9 AS h FROM own),
paths AS (
    SELECT l.c, coalesce(list_slice(f.turns, 1, l.h), []) || list_slice(l.turns, l.h + 1, len(l.turns)) AS turns
    FROM lengths l LEFT JOIN own f ON f.c = l.c - l.c % 5
),
members AS (
    SELECT c, d, list_transform(list_slice(turns, 1, d), lambda t: t.digest) AS node,
        CASE WHEN d = 0 THEN 0 ELSE turns[d].size END AS size, d = len(turns) AS ends
    FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM paths)
),
nodes AS (
    SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node, d
),
children AS (SELECT list_slice(node, 1, d - 1) AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
subtrees AS (
    SELECT list_slice(u.node, 1, u.a) AS node, sum(u.saved) AS saved, count(*) FILTER (u.n IS NULL) AS leaves
    FROM (
        SELECT nodes.node, nodes.saved, children.n, unnest(range(d + 1)) AS a
        FROM nodes LEFT JOIN children ON nodes.node = children.node
    ) u GROUP BY ALL
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
    t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v
JOIN subtrees t ON t.node = v.node
LEFT JOIN children k ON k.node = v.node
LEFT JOIN nodes p ON v.d > 0 AND p.node = list_slice(v.node, 1, v.d - 1)
"""
