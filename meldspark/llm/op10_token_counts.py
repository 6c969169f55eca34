"""Token counts: map-side lookup in two tiers.

Tier one is a compact table (sorted 64-bit hashes, one byte per length) of at most ``FREQUENT`` pre-tokens that are
frequent in the whole table; it is broadcast, at most 9 bytes an entry. Tier two is a cache in each worker, which the
tokenizer library fills with what the worker misses. Every whole text is counted.

What is frequent is counted over all rows and whole texts first: each task keeps a summary of ``FREQUENT`` entries, and
when more are known, all counts are lowered by the largest one that has no room. Any pre-token that makes up more than
1 in ``FREQUENT`` of all is in the merged summary, however the rows are dealt out. A task sends one row of hashes, counts
and lengths, so no pre-token is shuffled; rows are merged in three steps, one after the other, so that memory follows the
summary. The order of merging may change rare entries of tier one, never a token count.

Defined cases: null text counts as empty and has no tokens; an empty table gives an empty result and a table without
tier one; very long texts take memory in proportion to the longest one, and pre-tokens above ``WORD_BYTES`` bytes are left
to tier two; rows are independent, so repeated rows and ties need no rule; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.llm.pretokens import Splitter
from meldspark.llm.spans import SpanCache, bound_batches, chunks, row_sums, span_hashes
from meldspark.llm.tokenizer_files import load_tokenizer

VOCABULARY = "byte_bpe_50k.json"
FREQUENT = 65_536
WORD_BYTES = 256
MERGED_AT_ONCE = 32
LIMIT = 512

_WORKER: dict[str, tuple] = {}


def _worker(vocabulary: str) -> tuple:
    if vocabulary not in _WORKER:
        tokenizer = load_tokenizer(vocabulary)

        def lengths(words: list[bytes]) -> list[list[int]]:
            texts = [w.decode("utf-8", "replace") for w in words]
            return [[len(e.ids)] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        _WORKER[vocabulary] = Splitter(tokenizer), lengths, SpanCache()
    return _WORKER[vocabulary]


class Summary:
    """Counts of frequent keys, at most ``size`` of them: each is at most 1 in ``size`` of all occurrences too low."""

    def __init__(self, size: int = FREQUENT):
        self.size = size
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        #: What belongs to each key: its bytes, or its number of tokens.
        self.values: np.ndarray | None = None

    def add(self, keys: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        both = np.concatenate([self.keys, keys])
        values = values if self.values is None else np.concatenate([self.values, values])
        self.keys, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        added = np.concatenate([self.counts, counts])
        self.counts = np.bincount(inverse, weights=added, minlength=len(self.keys)).astype(np.int64)
        self.values = values[first]
        if len(self.keys) > self.size:
            place = len(self.keys) - self.size - 1
            self.counts -= np.partition(self.counts, place)[place]
            kept = self.counts > 0
            self.keys, self.counts, self.values = self.keys[kept], self.counts[kept], self.values[kept]


SUMMARY_SCHEMA = "keys array<long>, counts array<long>, lengths array<long>"


def _summary_row(keys: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
    ends = pa.array([0, len(keys)], pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int64))) for v in (keys.view(np.int64), counts, lengths)]
    return pa.RecordBatch.from_arrays(lists, ["keys", "counts", "lengths"])


def _merge(size: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = Summary(size)
        for batch in batches:
            for row in range(batch.num_rows):
                keys, counts, lengths = (c[row].values.to_numpy(zero_copy_only=False) for c in batch.columns)
                summary.add(keys.view(np.uint64), counts, lengths)
        if summary.values is not None:
            yield _summary_row(summary.keys, summary.counts, summary.values)

    return merge


def frequent_lengths(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, size: int = FREQUENT) -> tuple:
    """Tier one: (sorted hashes, lengths) of at most ``size`` pre-tokens, the frequent ones of all whole texts."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, encode, _ = _worker(vocabulary)
        summary = Summary(size)
        for _, data, offsets in chunks(batches, "_text"):
            starts, ends, _, special = splitter.spans(data, offsets)
            plain = (special < 0) & (ends - starts <= WORD_BYTES)
            starts, ends = starts[plain], ends[plain]
            keys, first, counts = np.unique(span_hashes(data, starts, ends), return_index=True, return_counts=True)
            words = np.empty(len(keys), object)
            raw = data.tobytes()
            words[:] = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            summary.add(keys, counts, words)
        if summary.values is not None:
            lengths = np.array([n[0] for n in encode(summary.values.tolist())], np.int64)
            yield _summary_row(summary.keys, summary.counts, lengths)

    tasks = docs.select(F.col(text).alias("_text")).mapInArrow(tally, SUMMARY_SCHEMA)
    dealt = tasks.repartition(F.spark_partition_id()).mapInArrow(_merge(size), SUMMARY_SCHEMA)
    fewer = dealt.repartition(MERGED_AT_ONCE, F.spark_partition_id()).mapInArrow(_merge(size), SUMMARY_SCHEMA)
    merged = fewer.repartition(1).mapInArrow(_merge(size), SUMMARY_SCHEMA).first()
    keys, counts, lengths = (np.array(merged[k] if merged else [], np.int64) for k in range(3))
    kept = (counts > 1) & (lengths < 256)
    hashes, lengths = keys.view(np.uint64)[kept], lengths[kept].astype(np.uint8)
    order = np.argsort(hashes)
    return hashes[order], lengths[order]


def chunk_counts(vocabulary: str, frequent: tuple, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of every row of a chunk."""
    splitter, encode, cache = _worker(vocabulary)
    hashes, lengths = frequent
    starts, ends, rows, special = splitter.spans(data, offsets)
    counts = np.ones(len(starts), np.int64)
    plain = np.flatnonzero(special < 0)
    of = span_hashes(data, starts[plain], ends[plain])
    place = np.searchsorted(hashes, of)
    found = np.zeros(len(plain), bool)
    inside = place < len(hashes)
    found[inside] = hashes[place[inside]] == of[inside]
    counts[plain[found]] = lengths[place[found]]
    missed = plain[~found]
    if len(missed):
        slots = cache.slots_of(data, starts[missed], ends[missed], encode)
        counts[missed] = cache.values[cache.starts[slots]]
    return row_sums(counts, rows, len(offsets) - 1)


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)  # before the counting pass as well
    shared = spark.sparkContext.broadcast(frequent_lengths(docs, text, vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "_text"):
            counts = chunk_counts(vocabulary, shared.value, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(count, SCHEMA)
