"""Benchmark decontamination with suffix arrays of the training text.

Spark deals the documents out in partitions; a task takes them in shards of bounded size. For a shard, all word
suffixes (cut at the end of their document) are sorted into a suffix array by prefix doubling up to the window, with the
benchmark's suffixes ranked in the same order. Every benchmark window is then found by binary search in the sorted
suffixes: an interval of the array holds all its occurrences, wherever they start. Occurrences that continue
each other are joined into the longest verbatim matches. Documents stay whole in one shard, so nothing is shuffled.
``with_stretches`` joins the matches of a document into stretches of hit words, which do not depend on which of several
equal windows stands for the others, nor on blocks.

The benchmark is the stated query set. It is read in blocks of at most ``BLOCK_BYTES`` of text (single items may be
longer), chosen by counted sizes; every block is one pass over the documents, and only the block of a pass is broadcast.

Defined cases: null, empty and wordless documents have no words and are clean; null and wordless items never
occur; items of equal text are all reported; a null item_id is not listed, but its words are hit; repeated rows and equal
doc_ids are separate rows; an empty table on either side gives no hits; extra columns are left alone, and a kept
column with the name of a result column is refused. Very long texts: memory follows a shard or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches, chunks, ragged, span_hashes, text_bytes
from meldspark.session import stage

WINDOW = 10
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 3 << 20


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    table[0x80:] = True
    return table


WORD_BYTES = _word_bytes()


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, words before each row): runs of ASCII letters, digits and all beyond ASCII."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    lower = data + 32 * ((data >= 65) & (data <= 90)).astype(np.uint8)
    inside = WORD_BYTES[lower]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    first, last = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    begins[first], stops[last] = inside[first], inside[last]
    starts = np.flatnonzero(begins)
    hashes = span_hashes(lower, starts, np.flatnonzero(stops) + 1)
    return hashes, np.searchsorted(starts, offsets)


class Block:
    """The words of a block of benchmark items."""

    def __init__(self, items: list[tuple]):
        data, offsets = text_bytes(pa.array([t for _, t in items], pa.string()))
        self.hashes, self.before = words_of(data, offsets)
        self.ids = [i for i, _ in items]
        sizes = np.diff(self.before)
        #: Words of every item's windows: ``WINDOW``, or all words of a shorter item.
        self.widths = np.minimum(sizes, WINDOW)
        self.counts = np.where(sizes > 0, sizes - self.widths + 1, 0)
        self.windows = ragged(self.before[:-1], self.counts)
        self.items = np.repeat(np.arange(len(items)), self.counts)


def _ahead(ranks: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """The rank ``step`` words later in the same text, 0 beyond its end."""
    result = np.zeros(len(ranks), np.int64)
    result[:-step] = ranks[step:]
    result[np.arange(len(ranks)) + step >= ends] = 0
    return result


class SuffixArray:
    """Word suffixes of a shard's rows, in order of their first ``WINDOW`` words, together with a block's suffixes."""

    def __init__(self, shard: np.ndarray, before: np.ndarray, block: Block):
        self.size = len(shard)
        words = np.concatenate([shard, block.hashes])
        ends = np.concatenate(
            [np.repeat(before[1:], np.diff(before)), len(shard) + np.repeat(block.before[1:], np.diff(block.before))]
        )
        self.ends = ends
        # ranks[n]: place of the first n words among all such prefixes; longer prefixes refine shorter ones.
        self.ranks = {1: np.unique(words, return_inverse=True)[1].astype(np.int64) + 1}
        top = len(words) + 2
        width = 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            pair = self.ranks[width] * top + _ahead(self.prefix(step), ends, width)
            self.ranks[width + step] = np.unique(pair, return_inverse=True)[1].astype(np.int64) + 1
            width += step
        self.order = np.argsort(self.ranks[WINDOW][: self.size], kind="stable")

    def prefix(self, width: int) -> np.ndarray:
        """Ranks by the first ``width`` words; equal exactly if those words are equal and all there."""
        if width not in self.ranks:
            half = max(k for k in self.ranks if k < width)
            top = len(self.ends) + 2
            pair = self.ranks[half] * top + _ahead(self.prefix(width - half), self.ends, half)
            self.ranks[width] = np.unique(pair, return_inverse=True)[1].astype(np.int64) + 1
        return self.ranks[width]

    def search(self, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in the array of the suffixes that begin with each window of ``width`` words."""
        ranks = self.prefix(width)
        sorted_ranks, wanted = ranks[: self.size][self.order], ranks[self.size + windows]
        return np.searchsorted(sorted_ranks, wanted, "left"), np.searchsorted(sorted_ranks, wanted, "right")


def shard_matches(data: np.ndarray, offsets: np.ndarray, block: Block) -> tuple:
    """For a shard: words of each row, and of every hit (row, first word, words, item, word of the item).

    A hit is a longest verbatim match along one place of an item. Of windows with equal words the first place in
    the block stands for all; ``pairs`` has every (row, item) with an occurring window.
    """
    hashes, before = words_of(data, offsets)
    counts = np.diff(before)
    none = np.zeros(0, np.int64)
    if not len(hashes) or not len(block.windows):
        return counts, none, none, none, none, none, (none, none)
    array = SuffixArray(hashes, before, block)
    found: list[tuple] = []
    pairs: list[np.ndarray] = []
    row_of = np.repeat(np.arange(len(counts)), counts)
    for width in np.unique(block.widths[block.widths > 0]).tolist():
        mine = np.flatnonzero(block.widths[block.items] == width)
        low, high = array.search(block.windows[mine], width)
        mine, low, high = mine[high > low], low[high > low], high[high > low]
        if not len(mine):
            continue
        distinct, first, group = np.unique(low, return_index=True, return_inverse=True)
        lengths = (high - low)[first]
        places = array.order[ragged(distinct, lengths)]
        which = np.repeat(np.arange(len(distinct)), lengths)
        found.append((places, block.windows[mine[first]][which], np.full(len(places), width)))
        rows = np.unique(row_of[places] * len(distinct) + which)
        # Distinct items of each window, then (row, window) -> (row, item).
        items = np.unique(group * len(block.ids) + block.items[mine])
        owner = items // len(block.ids)
        size = np.bincount(owner, minlength=len(distinct))
        start = np.cumsum(size) - size
        row, window = rows // len(distinct), rows % len(distinct)
        item = items[ragged(start[window], size[window])] % len(block.ids)
        pairs.append(np.unique(np.repeat(row, size[window]) * len(block.ids) + item))
    if not found:
        return counts, none, none, none, none, none, (none, none)
    place, at, width = (np.concatenate(x) for x in zip(*found))
    item = np.searchsorted(block.before, at, side="right") - 1
    order = np.lexsort((place, place - at, width))
    place, at, width, item = place[order], at[order], width[order], item[order]
    first = np.ones(len(place), bool)
    follows = (place[1:] == place[:-1] + 1) & (at[1:] == at[:-1] + 1) & (item[1:] == item[:-1])
    first[1:] = ~(follows & (row_of[place[1:]] == row_of[place[:-1]]) & (width[1:] == width[:-1]))
    begins = np.flatnonzero(first)
    sizes = np.diff(np.append(begins, len(place)))
    row = row_of[place[begins]]
    both = np.unique(np.concatenate(pairs))
    hits = (row, place[begins] - before[row], width[begins] + sizes - 1, item[begins], at[begins] - block.before[item[begins]])
    return counts, *hits, (both // len(block.ids), both % len(block.ids))


MATCH_SCHEMA = (
    "n_words long, spans array<struct<start:long,words:long,item_id:string,item_start:long>>, item_ids array<string>"
)


def _scan(rows: DataFrame, block: Block) -> DataFrame:
    """Columns of ``rows`` without _text, then the columns of ``MATCH_SCHEMA`` for one block."""
    shared = rows.sparkSession.sparkContext.broadcast(block)
    kept = rows.drop("_text").columns
    schema = rows.drop("_text").withColumns(
        {part.split(" ")[0]: F.lit(None).cast(part.split(" ", 1)[1]) for part in MATCH_SCHEMA.split(", ")}
    ).schema

    def lists(owner: np.ndarray, rows: int, values: pa.Array) -> pa.ListArray:
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        names = np.array([None if i is None else str(i) for i in block.ids], object)
        for batch, data, offsets in chunks(batches, "_text", SHARD_BYTES):
            words, row, start, size, item, at, (pair_row, pair_item) = shard_matches(data, offsets, block)
            order = np.lexsort((item, size, start, row))
            spans = pa.StructArray.from_arrays(
                [pa.array(start[order], pa.int64()), pa.array(size[order], pa.int64()),
                 pa.array(names[item[order]], pa.string()), pa.array(at[order], pa.int64())],
                ["start", "words", "item_id", "item_start"],
            )
            listed = lists(pair_row, batch.num_rows, pa.array(names[pair_item], pa.string()))
            kept_columns = [batch.column(name) for name in kept]
            columns = [*kept_columns, pa.array(words, pa.int64()), lists(row, batch.num_rows, spans), listed]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return rows.mapInArrow(scan, schema)


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The items dealt into blocks of about ``block_bytes`` by their summed size; nothing is collected here."""
    items = benchmark.select("item_id", F.col("text").alias("_t")).filter(F.col("_t").isNotNull())
    total = items.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    if blocks == 1:
        return [items]
    dealt = stage(items.withColumn("_block", F.pmod(F.xxhash64("item_id", "_t"), F.lit(blocks))), "benchmark-blocks")
    return [dealt.filter(F.col("_block") == block).select("item_id", "_t") for block in range(blocks)]


def _covered() -> F.Column:
    """Words inside any span; ``spans`` is in order of its starts."""
    reach = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(state, span):
        end = span["start"] + span["words"]
        return F.struct(
            F.greatest(state["end"], end).alias("end"),
            (state["n"] + F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))).alias("n"),
        )

    return F.aggregate("spans", reach, step, lambda state: state["n"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep``, n_words, n_hit, spans (longest matches with their places) and item_ids of every document."""
    if taken := {"n_words", "n_hit", "spans", "item_ids"} & set(keep):
        raise ValueError(f"kept columns are named like results: {sorted(taken)}; rename them first")
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    blocks = benchmark_blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        found = _scan(rows, Block([tuple(r) for r in blocks[0].collect()]))
    else:
        rows = stage(rows.withColumn("_uid", F.monotonically_increasing_id()), "decontamination-rows")
        found = None
        for items in blocks:  # one block at a time on the driver; a pass is written before the next begins
            one = stage(_scan(rows.select("_uid", "_text"), Block([tuple(r) for r in items.collect()])), "matches")
            found = one if found is None else found.unionByName(one.filter(F.size("item_ids") + F.size("spans") > 0))
        merged = found.groupBy("_uid").agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"),
        )
        found = rows.drop("_text").join(merged, "_uid").drop("_uid")
    item_ids = F.array_sort(F.array_distinct(F.filter("item_ids", lambda i: i.isNotNull())))
    return found.select(*keep, "n_words", _covered().alias("n_hit"), "spans", item_ids.alias("item_ids"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """All columns of the documents in which no benchmark window occurs."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    return contamination(packed, benchmark, ("row",)).filter("n_hit = 0").select("row.*")


def stretches_of(owners: np.ndarray, starts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first word, words) of the runs of words inside any span; spans come in order of owner and start."""
    if not len(starts):
        return owners, starts, words
    room = int((starts + words).max()) + 1
    begin = owners * room + starts
    reach = np.maximum.accumulate(begin + words)
    first = np.ones(len(begin), bool)
    first[1:] = (begin[1:] > reach[:-1]) | (owners[1:] != owners[:-1])
    at = np.flatnonzero(first)
    return owners[at], starts[at], reach[np.append(at[1:], len(begin)) - 1] - begin[at]


def with_stretches(found: DataFrame) -> DataFrame:
    """``found`` and a column ``stretches`` array<struct<start, words>>: the runs of words inside any of ``spans``."""
    schema = found.withColumn("stretches", F.lit(None).cast("array<struct<start:long,words:long>>")).schema

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            owners = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
            start, words = (spans.flatten().field(name).to_numpy() for name in ("start", "words"))
            owner, first, size = stretches_of(owners, start, words)
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))])
            values = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(size, pa.int64())], ["start", "words"])
            joined = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, joined], schema.names)

    return found.mapInArrow(join, schema)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans) of every document; ``hit_spans`` has the
    places: ``first word:words`` of every stretch of hit words, words numbered from 0, comma-joined."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = lambda s: F.concat_ws(":", s["start"].cast("string"), s["words"].cast("string"))
    return with_stretches(contamination(rows, benchmark)).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.array_join(F.transform("stretches", place), ",").alias("hit_spans"),
    )
