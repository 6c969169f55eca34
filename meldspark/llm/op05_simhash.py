"""Near duplicates by SimHash, with links found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits. The perfect Golay code of length 23 decodes every
segment value to one of 4096 codewords; the values one bit away decode to at most six different ones. So two values
that differ in one bit share a key if one side brings all its nearby codewords and the other its own.

With three differing bits in three segments, the errors are spread in one of two ways:

* some segment is equal and another differs in one bit at most: key = equal segment, codeword of the other;
* every segment differs in exactly one bit: key = the equal half of the first segment, codewords of both others.

Keys have 33 to 35 bits, so a key holds few fingerprints also among billions. Only distinct fingerprints take part;
equal keys meet by a hash shuffle and are verified bit by bit. A key of many fingerprints gives a spanning forest
of its links, not all pairs; a key of more than ``MAX_RUN`` is dealt out as pairs of blocks, so no task gets an
unbounded group. Components come from alternating star contraction, whose rounds are written to the shared folder.

Defined cases: null, empty and blank texts have fingerprint zero, which links like any other; texts of one or two
words have a single shingle; equal rows and equal doc_ids are separate rows of one component; a null doc_id is
ignored by the minimum (a component of such rows alone has a null id); an empty table gives an empty result; extra
columns, whatever their names, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches, chunks, ragged
from meldspark.session import stage

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
MAX_RUN = 8192
GENERATOR = 0b101011100011  # of the Golay code, fixed: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def _remainder(value: int) -> int:
    for bit in range(22, 10, -1):
        if value >> bit & 1:
            value ^= GENERATOR << (bit - 11)
    return value


class Golay:
    """Index (12 bits) of the codeword within three bits of each 23-bit value."""

    def __init__(self):
        self.low = np.array([_remainder(v) for v in range(1 << 12)], np.int64)
        self.high = np.array([_remainder(v << 12) for v in range(1 << 11)], np.int64)
        self.error = np.zeros(1 << 11, np.int64)
        single = [1 << k for k in range(23)]
        for a in range(23):
            for b in range(a, 23):
                for c in range(b, 23):
                    pattern = single[a] | single[b] | single[c]
                    self.error[_remainder(pattern)] = pattern

    def index(self, values: np.ndarray) -> np.ndarray:
        syndrome = self.low[values & 0xFFF] ^ self.high[values >> 12]
        return (values ^ self.error[syndrome]) >> 11

    def nearby(self, values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, index): the distinct codewords of each value and of all values one bit away."""
        flips = np.array([0, *(1 << k for k in range(bits))], np.int64)
        found = np.sort(self.index(values[:, None] ^ flips), axis=1)
        new = np.ones(found.shape, bool)
        new[:, 1:] = found[:, 1:] != found[:, :-1]
        position, column = np.nonzero(new)
        return position, found[position, column]


def fuzzy_keys(prints: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of every fingerprint: two within ``MAX_BITS`` bits share a key."""
    parts = [(prints >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    own = [code.index(p) for p in parts]
    near = [code.nearby(p, bits) for p, (_, bits) in zip(parts, SEGMENTS)]
    positions, keys = [], []

    def add(kind: int, position: np.ndarray, key: np.ndarray) -> None:
        positions.append(position)
        keys.append(np.int64(kind) << 56 | key)

    kind = 0
    for equal in range(3):
        for other in range(3):
            if equal != other:
                at, index = near[other]
                add(kind, at, parts[equal][at] << 12 | index)
                kind += 1
    for half in (0, 11):
        exact = parts[0] >> half & 0x7FF
        at, index = near[1]
        add(kind, at, (exact[at] << 12 | index) << 12 | own[2][at])
        at, index = near[2]
        other = index != own[2][at]
        at, index = at[other], index[other]
        add(kind, at, (exact[at] << 12 | own[1][at]) << 12 | index)
        kind += 1
    return np.concatenate(positions), np.concatenate(keys)


def chunk_fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The unsigned fingerprint of every row of a chunk."""
    rows = len(offsets) - 1
    result = np.zeros(rows, np.uint64)
    if not len(data):
        return result
    lower = data + 32 * ((data >= 65) & (data <= 90)).astype(np.uint8)
    inside = ~SPACES[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    begins[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return result
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] = inside[last]
    lengths = np.flatnonzero(stops) + 1 - starts
    places = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    joined[ragged(places, lengths)] = lower[ragged(starts, lengths)]
    raw = joined.tobytes()
    owner = np.searchsorted(offsets, starts, side="right") - 1
    words = np.bincount(owner, minlength=rows)
    first_word = np.cumsum(words) - words
    shingles = np.where(words >= SHINGLE_WORDS, words - SHINGLE_WORDS + 1, np.minimum(words, 1))
    head = ragged(first_word, shingles)
    tail = head + np.repeat(np.minimum(words, SHINGLE_WORDS), shingles) - 1
    hashed, ends = xxhash.xxh64_intdigest, places[tail] + lengths[tail]
    hashes = np.fromiter((hashed(raw[a:b], SEED) for a, b in zip(places[head].tolist(), ends.tolist())), np.uint64, len(head))
    # Bits are counted eight at a time in byte lanes, in blocks of 255 shingles, so that no lane overflows.
    blocks = -(-shingles // 255)
    block_starts = ragged(np.zeros(rows, np.int64), blocks) * 255 + np.repeat(np.cumsum(shingles) - shingles, blocks)
    filled = np.flatnonzero(shingles)
    first_block = (np.cumsum(blocks) - blocks)[filled]
    for bit in range(8):
        lanes = hashes >> np.uint64(bit) & np.uint64(0x0101010101010101)
        counts = np.add.reduceat(lanes, block_starts).astype("<u8").view(np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(counts.astype(np.int64), first_block, axis=0)
        over = sums * 2 > shingles[filled, None]
        for lane in range(8):
            result[filled] |= over[:, lane].astype(np.uint64) << np.uint64(8 * lane + bit)
    return result


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep``, then ``fp``: the fingerprint's bits as a signed long."""
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = rows.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "_text"):
            prints = pa.array(chunk_fingerprints(data, offsets).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], prints], [f.name for f in schema])

    return rows.mapInArrow(compute, schema)


def _forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints of a key which are connected by links, at most one less than those."""
    left, right, rest = [], [], prints
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            one = queue.pop()
            near = np.bitwise_count((rest ^ one).view(np.uint64)) <= MAX_BITS
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), one))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys; ``keys`` is sorted."""
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(begins, len(keys)))
    left, right = [], []
    short = np.repeat(np.where(sizes <= 8, sizes, 0), sizes)
    place = np.arange(len(keys)) - np.repeat(begins, sizes)
    for step in range(1, 8):
        at = np.flatnonzero(place + step < short)
        a, b = prints[at], prints[at + step]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_BITS
        left.append(a[near])
        right.append(b[near])
    for k in np.flatnonzero(sizes > 8).tolist():
        a, b = _forest(np.unique(prints[begins[k] : begins[k] + sizes[k]]))
        left.append(a)
        right.append(b)
    a, b = np.concatenate(left), np.concatenate(right)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
    return pairs[:, 0], pairs[:, 1]


LINK_SCHEMA = "a long, b long, deferred boolean"


def _link_sorted(max_run: int | None):
    """For mapInArrow on (key, fp) sorted by key: links (a, b), or (key, fp, true) of keys above ``max_run``."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a: np.ndarray, b: np.ndarray, deferred: bool) -> pa.RecordBatch:
            flags = pa.array(np.full(len(a), deferred))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), flags], ["a", "b", "deferred"])

        keys = prints = np.zeros(0, np.int64)
        large = None  # the key whose rows are being handed on
        for batch in batches:
            more, other = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            if large is not None:
                same = int(np.searchsorted(more, large, side="right"))
                if same:
                    yield out(more[:same], other[:same], True)
                more, other = more[same:], other[same:]
                if len(more):
                    large = None
            keys, prints = np.concatenate([keys, more]), np.concatenate([prints, other])
            if not len(keys):
                continue
            begin = int(np.searchsorted(keys, keys[-1]))
            yield out(*split(keys[:begin], prints[:begin], out_rows := []), False)
            yield from (out(a, b, True) for a, b in out_rows)
            keys, prints = keys[begin:], prints[begin:]
            if max_run and len(keys) > max_run:
                yield out(keys, prints, True)
                large, keys, prints = keys[0], keys[:0], prints[:0]
        if len(keys):
            yield out(*_links(keys, prints), False)

    def split(keys: np.ndarray, prints: np.ndarray, too_long: list) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return keys, prints
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(begins, len(keys)))
        if max_run and (sizes > max_run).any():
            long_rows = np.repeat(sizes > max_run, sizes)
            too_long.append((keys[long_rows], prints[long_rows]))
            keys, prints = keys[~long_rows], prints[~long_rows]
            if not len(keys):
                return keys, prints
        return _links(keys, prints)

    return link


def fingerprint_links(distinct: DataFrame, max_run: int = MAX_RUN) -> DataFrame:
    """(a, b), a < b: links that connect all distinct fingerprints ``fp`` at ``MAX_BITS`` bits or fewer."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(prints), 4096):
                part = prints[at : at + 4096]
                position, keys = fuzzy_keys(part.view(np.uint64), code)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[position])], ["key", "fp"])

    keyed = distinct.select("fp").mapInArrow(expand, "key long, fp long")
    found = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_link_sorted(max_run), LINK_SCHEMA)
    found = stage(found, "simhash-links")
    links = found.filter(~F.col("deferred")).select("a", "b")
    deferred = found.filter("deferred").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    if not deferred.isEmpty():
        half = F.lit(max_run // 2)
        blocks = deferred.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / half).cast("int").alias("_blocks"))
        own = F.pmod(F.xxhash64("fp"), F.col("_blocks")).cast("int")
        dealt = (
            deferred.join(blocks, "key")
            .withColumn("_own", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .select(F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("key"), "fp")
        )
        more = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_link_sorted(None), LINK_SCHEMA)
        links = links.union(stage(more.select("a", "b"), "simhash-blocks"))
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every linked node, by alternating star contraction."""
    stars = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "stars")
    sums = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    state = stars.agg(*sums).first()
    while True:
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.distinct().join(least, "a")
        small = joined.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = stage(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        before, state = state, stars.agg(*sums).first()
        if state == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", max_run: int = MAX_RUN):
    """Columns ``keep``, ``fp`` and ``component_id``: the smallest doc_id reachable over links, itself included."""
    prints = stage(fingerprints(docs, keep, text), "fingerprints")
    firsts = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("_first")), "distinct-fingerprints")
    roots = components(fingerprint_links(firsts, max_run))
    linked = firsts.join(roots, F.col("fp") == F.col("node"), "left")
    linked = linked.select("fp", "_first", F.coalesce("root", "fp").alias("_root"))
    smallest = linked.groupBy("_root").agg(F.min("_first").alias("component_id"))
    classes = linked.join(smallest, "_root").select("fp", "component_id")
    return prints.join(classes, "fp").select(*keep, "fp", "component_id")


def one_of_each_group(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of the rows that stay: the one with the smallest doc_id of each component (nulls last)."""
    table = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")), "rows")
    flat = table.select(F.col("row.doc_id").cast("long").alias("doc_id"), "uid", F.col(f"row.{text}").alias("text"))
    grouped = near_duplicates(flat, ("doc_id", "uid"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    # Rows without doc_id are grouped by fingerprint, as their component has no id.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")))
    stays = grouped.groupBy(group.alias("_group")).agg(F.min_by("uid", rank).alias("uid"))
    return table.join(stays.select("uid"), "uid", "left_semi").select("row.*")


def near_duplicate_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = near_duplicates(rows)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
