"""Texts of an Arrow batch as one byte array: classes of code points, spans, span hashes, a cache by span.

Everything works on a bounded chunk of whole rows, so memory follows the longest text, not the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

CHUNK_BYTES = 2 << 20
BATCH_BYTES = 8 << 20

_M1, _M2, _M3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))


def bound_batches(spark: SparkSession) -> None:
    """Lowers the bytes of text that Spark hands to a Python worker at once to ``BATCH_BYTES``."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key))
    except ValueError:
        now = BATCH_BYTES + 1
    if now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and int64 offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(rows, bytes, offsets): runs of whole rows with about ``size`` bytes of text, one row at least."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        row, rows = 0, batch.num_rows
        while row < rows:
            end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
            end = min(max(end, row + 1), rows)
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def lead_code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, code points and byte lengths of all characters beyond ASCII."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    length = np.where(lead >= 0xF0, 4, np.where(lead >= 0xE0, 3, 2))
    point = np.where(lead >= 0xF0, lead & 7, np.where(lead >= 0xE0, lead & 15, lead & 31))
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    for k in (1, 2, 3):
        more = length > k
        point[more] = point[more] << 6 | padded[at[more] + k] & 63
    return at, point, length


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the slices (start, length), one slice after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    left = ends - starts
    result = _mix(left.astype(np.uint64) * _M3)
    active, at = np.arange(len(starts)), starts.astype(np.int64)
    while len(active):
        kept = np.minimum(left, 8).astype(np.uint64)
        lane = words[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - kept * np.uint64(8)) % np.uint64(64))
        lane[kept == 0] = 0
        result[active] = _mix(result[active] * _M3 + lane)
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
    return result


class SpanCache:
    """Integer lists by span hash, kept for the life of a worker and started anew above ``limit`` entries."""

    def __init__(self, limit: int = 1_000_000):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.values = np.zeros(0, np.int32)

    def slots_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode) -> np.ndarray:
        """The slot of every span; ``encode`` turns the list of unknown spans (bytes) into integer lists."""
        distinct, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.limit:
            self._clear()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        slots = np.empty(len(distinct), np.int64)
        slots[known] = self.slots[place[known]]
        if len(new):
            raw = data.tobytes()
            lists = encode([raw[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            values = np.fromiter((x for ids in lists for x in ids), np.int32, int(lengths.sum()))
            slots[new] = len(self.lengths) + np.arange(len(new))
            self.starts = np.concatenate([self.starts, len(self.values) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.values = np.concatenate([self.values, values])
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.slots = np.insert(self.slots, place[new], slots[new])
        return slots[inverse]

    def expand(self, slots: np.ndarray) -> np.ndarray:
        return self.values[ragged(self.starts[slots], self.lengths[slots])]


def row_sums(values: np.ndarray, owners: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``values`` for each row; ``owners`` has the row of each value."""
    return np.bincount(owners, weights=values, minlength=rows).astype(np.int64)
