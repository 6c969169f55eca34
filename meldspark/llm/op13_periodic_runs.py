"""Periodic runs of words by multi-scale minimizers.

A run is a maximal stretch of words with smallest period q and at least four periods (and ``MIN_WORDS`` words). Periods
below ``DIRECT`` are found by comparing all words with those q places on. Longer ones are found by scale: scale P
(``DIRECT``, twice that, and so on) has the periods from P to 2P-1. It hashes all grams of 2P words and takes the
minimizers, the leftmost least hash of every window of P grams. Inside a run of period q two windows q places apart are equal, so
their minimizers are q places apart too, and as a gram is no shorter than q, no equal gram stands between them: each
run has two neighbouring equal minimizers at distance q. Such a pair seeds an extension to both sides, which decides.
As equal grams overlap, every seed is a real repetition; their lengths add up to a multiple of the words for each
scale, so a text takes time in proportion to its words times the number of scales, and no pairs are listed.

Words are told apart by 64-bit hashes. A scale looks only at the texts that are long enough for four of its periods.

Defined cases: null text has no words and no runs; texts without words, shorter than ``MIN_WORDS`` or without a repetition give
an empty list; ties between runs need no rule, as all are returned, by start and period; repeated rows give
repeated results; an empty table gives an empty result; extra columns are ignored unless named in ``keep``, and a kept
column with the name of a result column is refused. Very long texts: memory follows the longest text, about a hundred
bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches, chunks, ragged, span_hashes

MIN_WORDS, MIN_PERIODS = 6, 4
DIRECT = 16  # a power of two; shorter periods are compared directly

_GRAM, _NONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFF)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the offsets of the rows among the words."""
    inside = np.concatenate([[False], ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D))), [False]])
    begins = inside[1:-1] & ~inside[:-2]
    begins[offsets[:-1][offsets[:-1] < len(data)]] |= inside[1:-1][offsets[:-1][offsets[:-1] < len(data)]]
    starts = np.flatnonzero(begins)
    stops = ~inside[2:] & inside[1:-1]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] |= inside[1:-1][last]
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of True with ``least`` elements or more."""
    gaps = np.concatenate([[-1], np.flatnonzero(~equal), [len(equal)]])
    lengths = np.diff(gaps) - 1
    found = np.flatnonzero(lengths >= least)
    return gaps[found] + 1, lengths[found]


def _minimizers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the leftmost least hash of every window of ``window`` (a power of two) grams."""
    values, places = grams, np.arange(len(grams))
    span = 1
    while span < window and len(values) > span:
        left, right = values[:-span], values[span:]
        smaller = right < left
        values = np.where(smaller, right, left)
        places = np.where(smaller, places[span:], places[:-span])
        span *= 2
    found = np.zeros(len(grams), bool)
    found[places] = True
    return np.flatnonzero(found & (grams != _NONE))


def _extended(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch around ``at`` whose words equal those ``lag`` places on: (start, end)."""
    end, step = at, 64
    while end + lag < len(words):
        size = min(step, len(words) - lag - end)
        differ = np.flatnonzero(words[end : end + size] != words[end + lag : end + lag + size])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + size, step * 2
    start, step = at, 64
    while start > 0:
        size = min(step, start)
        differ = np.flatnonzero(words[start - size : start] != words[start - size + lag : start + lag])
        if len(differ):
            start += int(differ[-1]) + 1 - size
            break
        start, step = start - size, step * 2
    return start, end


def _scale_runs(words: np.ndarray, doc_ends: np.ndarray, grams: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs with a period from ``scale`` to 2 * ``scale`` - 1; ``grams`` has the
    hashes of 2 * ``scale`` words, ``doc_ends`` the end of the text of each word."""
    valid = grams.copy()
    valid[np.arange(len(grams)) + 2 * scale > doc_ends[: len(grams)]] = _NONE
    places = _minimizers(valid, scale)
    order = places[np.argsort(valid[places], kind="stable")]
    lags = order[1:] - order[:-1]
    seeds = np.flatnonzero((valid[order[1:]] == valid[order[:-1]]) & (lags >= scale) & (lags < 2 * scale))
    found, last = [], (0, 0)
    by_lag = seeds[np.lexsort((order[seeds], lags[seeds]))]
    for at, lag in zip(order[by_lag].tolist(), lags[by_lag].tolist()):
        if last[0] == lag and at < last[1]:
            continue
        start, end = _extended(words, at, lag)
        last = lag, end
        if end - start + lag >= max(MIN_WORDS, MIN_PERIODS * lag):
            found.append((start, end - start + lag, lag))
    return found


def runs_of(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, periods) of all runs in rows of word hashes, by start and period; starts count all rows'
    words."""
    # One place behind each row keeps every comparison within its row.
    sizes = np.diff(offsets)
    row_ends = offsets[1:] + np.arange(len(sizes))
    own = np.ones(len(words) + len(sizes), bool)
    own[row_ends] = False
    border = np.cumsum(~own)  # borders up to each place
    padded = np.empty(len(own), np.uint64)
    padded[own] = words
    padded[~own] = np.arange(1, len(sizes) + 1).astype(np.uint64) << np.uint64(32)  # each differs from all others
    starts, lengths, periods = [], [], []
    for lag in range(1, min(DIRECT, len(padded))):
        at, size = _stretches(padded[:-lag] == padded[lag:], max(MIN_WORDS, MIN_PERIODS * lag) - lag)
        starts.append(at)
        lengths.append(size + lag)
        periods.append(np.full(len(at), lag, np.int64))
    scale = DIRECT
    found: list[tuple[int, int, int]] = []
    while len(sizes) and sizes.max() >= MIN_PERIODS * scale:
        long = sizes >= MIN_PERIODS * scale
        places = np.flatnonzero(np.repeat(long, sizes + 1))
        part = padded[places]
        numbers = (sizes + 1)[long]
        part_ends = np.repeat(np.cumsum(numbers) - 1, numbers)
        grams, size = part, 1
        while size < 2 * scale:
            left, right = grams[:-size], grams[size:]
            grams = (left * _GRAM ^ (left >> np.uint64(29))) + (right ^ (right >> np.uint64(32)))
            size *= 2
        found += [(int(places[s]), n, q) for s, n, q in _scale_runs(part, part_ends, grams, scale)]
        scale *= 2
    if found:
        at, size, lag = (np.array(x, np.int64) for x in zip(*found))
        starts.append(at)
        lengths.append(size)
        periods.append(lag)
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none
    at, size, lag = (np.concatenate(x).astype(np.int64) for x in (starts, lengths, periods))
    # A stretch repeats at multiples of its period too; the smallest one counts.
    order = np.lexsort((lag, size, at))
    at, size, lag = at[order], size[order], lag[order]
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1]) | (size[1:] != size[:-1])
    at, size, lag = at[first], size[first], lag[first]
    order = np.lexsort((lag, at))
    at, size, lag = at[order], size[order], lag[order]
    return at - border[at], size, lag


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _map_words(rows: DataFrame, schema, columns, kept: list[str]) -> DataFrame:
    """Maps chunks of rows; ``columns`` makes the new columns from (data, word starts, word ends, row offsets, runs)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "_text"):
            starts, ends, row_offsets = word_spans(data, offsets)
            runs = runs_of(span_hashes(data, starts, ends), row_offsets)
            made = columns(data, starts, ends, row_offsets, runs)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], schema.names)

    return rows.mapInArrow(apply, schema)


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, then ``runs``: start (word number from 0), length and period of every run of every text."""
    if "runs" in keep:
        raise ValueError("a kept column is named runs; rename it first")
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = rows.select(*keep, F.lit(None).cast(f"array<{RUN}>").alias("runs")).schema

    def columns(data, starts, ends, row_offsets, runs):
        at, size, lag = runs
        first = np.searchsorted(at, row_offsets)
        own = at - np.repeat(row_offsets[:-1], np.diff(first))
        fields = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (own, size, lag)], ["start", "length", "period"])
        return [pa.ListArray.from_arrays(pa.array(first, pa.int32()), fields)]

    return _map_words(rows, schema, columns, list(keep))


def _kept_words(words: int, at: np.ndarray, size: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """Whether each word stays if every run is reduced to its first period."""
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, at + lag, 1)
    np.add.at(cover, at + size, -1)
    return np.cumsum(cover[:-1]) == 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with a space before each, and where each row begins; ``first`` has the offsets of the rows."""
    spaced = np.concatenate([data, np.array([0x20], np.uint8)])
    lengths = ends - starts + 1
    index = ragged(starts - 1, lengths)
    begins = np.cumsum(lengths) - lengths
    index[begins] = len(data)
    return spaced[index].tobytes(), np.concatenate([[0], np.cumsum(lengths)])[first]


def collapse_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, then ``text``: the words of every text joined by one space, every run reduced to its first
    period (a word goes if any run has it after its first period)."""
    if "text" in keep:
        raise ValueError("a kept column is named text; rename it first")
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = rows.select(*keep, F.lit("").alias("text")).schema

    def columns(data, starts, ends, row_offsets, runs):
        stay = _kept_words(len(starts), *runs)
        first = np.concatenate([[0], np.cumsum(stay)])[row_offsets]
        raw, begins = _joined(data, starts[stay], ends[stay], first)
        return [pa.array([raw[a + 1 : b].decode() for a, b in zip(begins, begins[1:])], pa.string())]

    return _map_words(rows, schema, columns, list(keep))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: a tenth of the texts (by crc32 of doc_id) turned periodic from some word on, all others as they are;
    a null doc_id stays as it is. Built-in functions only; words are evaluated for the tenth alone."""
    words: Column = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", hashed.alias("_h"))
    chosen = F.when(F.col("_h") % 10 == 0, words)
    rows = rows.withColumn("_words", chosen).withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_g", F.floor(F.col("_h") / 10))
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    rows = rows.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    repeated = F.expr(
        "array_join(transform(sequence(0L, _n - 1), i -> _words[CAST(IF(i < _a, i, _a + (i - _a) % _p) AS int)]), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text")).alias("text"))


DIGEST_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _best(runs: list[tuple[int, int, int]]) -> tuple[int | None, int | None, int | None, int | None]:
    """The run with the greatest length by period, the first one of equals, and its exponent in thousandths."""
    best = None
    for start, size, lag in runs:  # by start, then period
        if best is None or size * best[2] > best[1] * lag:
            best = start, size, lag
    return (*best, 1000 * best[1] // best[2]) if best else (None, None, None, None)


def run_digests(docs: DataFrame) -> DataFrame:
    """Of every text the number of runs, the best run, and digests of all runs and of the collapsed text."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    schema = rows.sparkSession.createDataFrame([], DIGEST_SCHEMA).schema

    def columns(data, starts, ends, row_offsets, runs):
        at, size, lag = runs
        first = np.searchsorted(at, row_offsets)
        stay = _kept_words(len(starts), at, size, lag)
        raw, begins = _joined(data, starts[stay], ends[stay], np.concatenate([[0], np.cumsum(stay)])[row_offsets])
        collapsed = [hashlib.sha256(raw[a + 1 : b]).hexdigest() for a, b in zip(begins, begins[1:])]
        best, shas = [], []
        for row, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
            own = list(zip((at[a:b] - row_offsets[row]).tolist(), size[a:b].tolist(), lag[a:b].tolist()))
            best.append(_best(own))
            shas.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest())
        numbers = [pa.array([x[k] for x in best], pa.int64()) for k in range(4)]
        return [pa.array(np.diff(first), pa.int64()), *numbers, pa.array(shas, pa.string()), pa.array(collapsed, pa.string())]

    return _map_words(rows, schema, columns, ["doc_id"])
