"""Byte-level BPE over overlapping chunks.

Texts above a chunk's size are cut into overlapping chunks, which are dealt out over the cluster, so that one giant text is
the work of many tasks. Every chunk is pre-tokenised from its own first byte, as if a pre-token began there. Two
neighbours are stitched at the first position of their overlap that both have as a border and that is surely one of
the whole text; the pieces between stitches are encoded, each pre-token by itself, and put together in order.
Where neighbours don't resynchronise (a pre-token longer than the overlap), their chunks form one longer piece.
Shorter texts are one chunk and need no stitch. Decoding concatenates the bytes of the ids.

A position is surely a border of the whole text if it follows, in the same chunk, a change from letters, numbers or
other signs to another class (not from an apostrophe to a letter, which may be a contraction): no pre-token reaches
over such a change, whatever stands before it. From there on, equal text gives equal borders. Pieces are parted only
behind a character that is no white space, so that they split alone as they do within the text.

Defined cases: null text counts as empty and gives no ids; rows are independent, so repeated rows, ties and null ids
need no rule; an empty table gives an empty result; extra columns are ignored unless named in ``keep``, and a kept column
with the name of a result column is refused. Very long texts: memory follows a chunk or, where neighbours don't resynchronise, the pre-token
that keeps them from it; only the ids of a text have to fit into one row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meldspark.llm.pretokens import LETTER, NUMBER, OTHER, WHITE, Splitter
from meldspark.llm.spans import SpanCache, bound_batches, chunks, ragged, row_sums, text_bytes
from meldspark.llm.tokenizer_files import vocabulary_path
from meldspark.session import broadcast_if_small, stage

VOCABULARY = "byte_bpe_50k.tiktoken"
CHUNK_BYTES, OVERLAP_BYTES = 32_768, 256
LOOKAHEAD = 8  # bytes; the pattern looks at one character beyond a pre-token, or two within a contraction


class RankSplitter(Splitter):
    """The pre-tokens of the pattern, with the character classes of the library that reads rank files."""

    def __init__(self):
        import tiktoken

        single = {bytes([b]): b for b in range(256)}
        self._kinds = [
            (kind, tiktoken.Encoding(str(kind), pat_str=pattern, mergeable_ranks=single, special_tokens={}))
            for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s"))
        ]
        self._ascii = np.array([self._class(chr(c)) for c in range(128)], np.uint8)
        self._beyond: dict[int, int] = {}
        self.special = {}

    def classes(self, data: np.ndarray) -> np.ndarray:
        """The class of every byte's character."""
        return self._classes(data)

    def _class(self, char: str) -> int:
        return next((kind for kind, encoding in self._kinds if encoding.encode_ordinary(char)), OTHER)

    def anchors(self, data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Positions that are borders of pre-tokens whatever stands before ``data``."""
        left, right = kinds[:-1], kinds[1:]
        contraction = (data[:-1] == 0x27) & (right == LETTER)
        return np.flatnonzero((left != right) & (left != WHITE) & ~contraction) + 1


class RankCoder:
    """Encodes pre-tokens by ranks, and has the bytes and the decimal text of every id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._whole = tiktoken.Encoding("whole", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.bytes = _Strings(dict(zip(ranks.values(), ranks)), size)
        self.decimals = _Strings({k: b" %d" % k for k in range(size)}, size)

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        return [self._whole.encode_ordinary(word.decode()) for word in words]


class _Strings:
    """The byte string of every id, gathered for many ids at once."""

    def __init__(self, strings: dict[int, bytes], size: int):
        self.lengths = np.array([len(strings.get(k, b"")) for k in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings.get(k, b"") for k in range(size)), np.uint8)

    def of(self, ids: np.ndarray, row_offsets: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The strings of all ids, and where each row begins in them."""
        lengths = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.data[ragged(self.starts[ids], lengths)].tobytes(), ends[row_offsets]


_WORKER: dict[str, tuple[RankCoder, SpanCache]] = {}
_SPLITTER: list[RankSplitter] = []


def _splitter() -> RankSplitter:
    if not _SPLITTER:
        _SPLITTER.append(RankSplitter())
    return _SPLITTER[0]


def _worker(vocabulary: str) -> tuple[RankCoder, SpanCache]:
    if vocabulary not in _WORKER:
        _WORKER[vocabulary] = RankCoder(vocabulary_path(vocabulary)), SpanCache()
    return _WORKER[vocabulary]


def _encoded(rows: DataFrame, column: str, vocabulary: str) -> DataFrame:
    """All columns but ``column``, then ``ids``: every text of ``column`` from its first border to its last."""
    kept = [c for c in rows.columns if c != column]
    schema = rows.select(*kept, F.lit(None).cast("array<int>").alias("ids")).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, cache = _worker(vocabulary)
        for batch, data, offsets in chunks(batches, column):
            starts, ends, owners, _ = _splitter().spans(data, offsets)
            slots = cache.slots_of(data, starts, ends, coder.encode_words)
            totals = row_sums(cache.lengths[slots], owners, len(offsets) - 1)
            row_offsets = pa.array(np.concatenate([[0], np.cumsum(totals)]), pa.int32())
            lists = pa.ListArray.from_arrays(row_offsets, pa.array(cache.expand(slots), pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], [*kept, "ids"])

    return rows.select(*kept, column).mapInArrow(encode, schema)


def _cut(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of every text: uid, k, start, next (start of the following chunk, null for the last), end,
    part; _keep of the text stays with chunk 0. Starts and ends are bytes of the text, at characters."""
    schema = rows.selectExpr(
        "uid", "0L k", "0L start", "CAST(null AS long) next", "0L end", "'' part", "IF(uid < 0, null, _keep) _keep"
    ).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, _ = text_bytes(batch.column("_text").slice(row, 1))
                size = len(data)

                def at_character(p: int) -> int:
                    while p < size and data[p] & 0xC0 == 0x80:
                        p += 1
                    return min(p, size)

                number = max(1, -(-(size - overlap) // chunk))
                starts = [at_character(k * chunk) for k in range(number)]
                ends = [*(at_character((k + 1) * chunk + overlap) for k in range(number - 1)), size]
                for first in range(0, number, 64):  # a few megabytes at a time
                    ks = range(first, min(first + 64, number))
                    keep = batch.column("_keep").slice(row, 1)
                    none = pa.nulls(len(ks) - (first == 0), keep.type)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("uid")[row].as_py()] * len(ks), pa.int64()),
                            pa.array(list(ks), pa.int64()),
                            pa.array([starts[k] for k in ks], pa.int64()),
                            pa.array([starts[k + 1] if k + 1 < number else None for k in ks], pa.int64()),
                            pa.array([ends[k] for k in ks], pa.int64()),
                            pa.array([data[starts[k] : ends[k]].tobytes().decode() for k in ks], pa.string()),
                            pa.concat_arrays([keep, none]) if first == 0 else none,
                        ],
                        schema.names,
                    )

    return rows.mapInArrow(cut, schema)


def _marked(cut: DataFrame, overlap: int) -> DataFrame:
    """Chunks with ``head``, the borders where the previous chunk may end, and ``tail``, the sure borders where the
    next one may begin."""
    schema = cut.selectExpr("*", "array(0L) head", "array(0L) tail").schema

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _splitter()
        for batch, data, offsets in chunks(batches, "part"):
            starts, ends, _, _ = splitter.spans(data, offsets)
            kinds = splitter.classes(data)
            anchors = splitter.anchors(data, kinds)
            ends = ends[kinds[ends - 1] != WHITE]
            heads, tails = [], []
            for row, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                k, start, following = (batch.column(c)[row].as_py() for c in ("k", "start", "next"))
                a, b = np.searchsorted(starts, [low, min(low + overlap + LOOKAHEAD, high)])
                heads.append(starts[a:b] - low + start)
                anchor = low if k == 0 else high
                if k and (place := np.searchsorted(anchors, low, side="right")) < len(anchors):
                    anchor = min(int(anchors[place]), high)
                least = max(anchor, low + (following - start if following is not None else high - low))
                a, b = np.searchsorted(ends, [least, high - LOOKAHEAD + 1])
                tails.append(ends[a:b] - low + start)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], schema.names)

    return cut.mapInArrow(mark, schema)


def _stitches(marked: DataFrame) -> DataFrame:
    """For every chunk (uid, k) the piece it belongs to, the bytes low to high of its part, and the piece's chunks."""
    order = Window.partitionBy("uid").orderBy("k")
    cut = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
    cuts = marked.select("uid", "k", "start", "next", "end", F.when(F.col("k") == 0, F.lit(0)).otherwise(cut).alias("cut"))
    low = F.coalesce("cut", "start")
    high = F.coalesce(F.lead("cut").over(order), F.col("next"), F.col("end"))
    pieces = cuts.select(
        "uid", "k", (low - F.col("start")).cast("int").alias("low"), (high - low).cast("int").alias("size"),
        F.max(F.when(F.col("cut").isNotNull(), F.col("k"))).over(order).alias("piece"),
    )
    return pieces.withColumn("chunks", F.count(F.lit(1)).over(Window.partitionBy("uid", "piece")))


def _long_encoded(long: DataFrame, vocabulary: str, chunk: int, overlap: int) -> DataFrame:
    """_keep, ids of texts with several chunks."""
    cut = _cut(long.withColumn("uid", F.monotonically_increasing_id()), chunk, overlap)
    dealt = cut.repartition("uid", "k")  # chunks of one text go to many tasks
    marked = stage(_marked(dealt, overlap), "bpe-chunks")
    stitches = stage(_stitches(marked), "bpe-stitches")
    part = F.expr("CAST(substring(CAST(part AS binary), low + 1, size) AS string)").alias("part")
    parts = marked.join(broadcast_if_small(stitches), ["uid", "k"]).select("uid", "k", "piece", "chunks", part, "_keep")
    alone = parts.filter("chunks = 1").select("uid", "piece", "_keep", "part")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "part"))), lambda x: x.part), "")
    several = parts.filter("chunks > 1").groupBy("uid", "piece").agg(
        F.first("_keep", ignorenulls=True).alias("_keep"), joined.alias("part")
    )
    encoded = _encoded(alone.unionByName(several), "part", vocabulary)
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x.ids))
    whole = encoded.groupBy("uid").agg(F.first("_keep", ignorenulls=True).alias("_keep"), ids.alias("ids"))
    return whole.select("_keep", "ids")


def byte_bpe_encode(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    vocabulary: str = VOCABULARY,
    chunk: int = CHUNK_BYTES,
    overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """Columns ``keep``, then ``ids`` array<int>: the ids of every whole text."""
    if "ids" in keep:
        raise ValueError("a kept column is named ids; rename it first")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("_keep"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    several = F.octet_length("_text") > chunk + overlap
    short = _encoded(rows.filter(~several), "_text", vocabulary)
    return short.unionByName(_long_encoded(rows.filter(several), vocabulary, chunk, overlap)).select("_keep.*", "ids")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists and the offsets of its rows; null counts as empty."""
    lengths = np.array(column.value_lengths().fill_null(0), np.int64)
    return np.array(column.flatten(), np.int64), np.concatenate([[0], np.cumsum(lengths)])


def byte_bpe_decode(
    encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids: str = "ids", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Columns ``keep``, then ``bytes`` binary: the concatenated bytes of all ids; null ids give no bytes."""
    rows = encoded.select(*keep, F.col(ids).alias("_ids"))
    schema = rows.select(*keep, F.lit(b"").alias("bytes")).schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(vocabulary)[0]
        for batch in batches:
            raw, at = coder.bytes.of(*_lists(batch.column(batch.num_columns - 1)))
            texts = pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], schema.names)

    return rows.mapInArrow(decode, schema)


DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_bpe_digests(docs: DataFrame, vocabulary: str = VOCABULARY, **sizes: int) -> DataFrame:
    """Every whole text encoded, the ids decoded, and both reduced to digests."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = byte_bpe_encode(rows, vocabulary=vocabulary, **sizes)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(vocabulary)[0]
        for batch in batches:
            ids, row_offsets = _lists(batch.column("ids"))
            shas = []
            for strings in (coder.decimals, coder.bytes):
                raw, at = strings.of(ids, row_offsets)
                space = strings is coder.decimals  # in front of each id, so the first one is left out
                shas.append([hashlib.sha256(raw[min(a + space, b) : b]).hexdigest() for a, b in zip(at, at[1:])])
            counts = pa.array(np.diff(row_offsets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, *(pa.array(s, pa.string()) for s in shas)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.mapInArrow(digests, DIGEST_SCHEMA)
