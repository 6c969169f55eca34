"""Token ids as Parquet files of shards in document order.

Texts are range-partitioned by document, encoded in that order and written once. A shard holds one row per document:
``token_ids`` is a list column with dictionary encoding, number columns are delta-encoded (Parquet format 2); row
groups and pages are bounded, and the page index that Parquet writes lets readers skip pages by ``doc_id`` or ``start``.
Offsets count within the shard; a small index of shards has the ids before each, so no pass over the ids is needed for
global positions. Reading numbers touches no id page, reading one document touches the pages around it.

Words are encoded by the tokenizer library, each distinct piece once per worker. Texts are cut into pieces only
where no token can reach across: at white space, and between an ASCII letter or digit and ASCII punctuation.

Defined cases: null text counts as empty and has the end id alone; null doc_id comes first; rows with one doc_id are
ordered by a hash of the text, equal rows are interchangeable; an empty table gives no rows; extra columns are stored
only if named in ``metadata``, and one with the name of a result column is refused. Very long texts: memory follows a
chunk or the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meldspark.llm.spans import SpanCache, bound_batches, chunks, ragged, row_sums
from meldspark.llm.tokenizer_files import load_tokenizer
from meldspark.session import broadcast_if_small, new_shared_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#token_ids.list.element": "true",
}

SPACE, WORD, SIGN, APOSTROPHE, BEYOND = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, SIGN, np.uint8)
    kinds[128:] = BEYOND
    kinds[[9, 10, 11, 12, 13, 32]] = SPACE
    for first, last in (b"09", b"AZ", b"az"):
        kinds[first : last + 1] = WORD
    kinds[0x27] = APOSTROPHE
    return kinds


KINDS = _kinds()
CUTS = np.zeros((5, 5), bool)
CUTS[SPACE, :] = CUTS[:, SPACE] = True
CUTS[WORD, SIGN] = CUTS[SIGN, WORD] = CUTS[WORD, APOSTROPHE] = True

_WORKER: dict[str, tuple] = {}


def _worker(vocabulary: str) -> tuple:
    if vocabulary not in _WORKER:
        tokenizer = load_tokenizer(vocabulary)

        def encode(pieces: list[bytes]) -> list[list[int]]:
            texts = [p.decode("utf-8", "replace") for p in pieces]
            return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

        special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]
        _WORKER[vocabulary] = encode, special, SpanCache()
    return _WORKER[vocabulary]


def encode_chunk(vocabulary: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows of a chunk, one row after the other, and how many each row has."""
    encode, special, cache = _worker(vocabulary)
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(rows, np.int64)
    kinds = KINDS[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    cut[1:-1] |= CUTS[kinds[:-1], kinds[1:]]
    raw = data.tobytes()
    for text in special:  # a text with a special token is encoded as a whole
        at = raw.find(text)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            cut[offsets[row] + 1 : offsets[row + 1]] = False
            at = raw.find(text, max(int(offsets[row + 1]), at + 1))
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data))
    filled = (kinds[starts] != SPACE) | (ends - starts > 1)
    starts, ends = starts[filled], ends[filled]
    slots = cache.slots_of(data, starts, ends, encode)
    owners = np.searchsorted(offsets, starts, side="right") - 1
    return cache.expand(slots), row_sums(cache.lengths[slots], owners, rows)


def encode_in_order(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID, metadata: Sequence[str] = ()
) -> DataFrame:
    """(doc_id, metadata, n_tokens, shard_start, shard, token_ids): documents in ascending order, shard by shard."""
    if taken := {"doc_id", "n_tokens", "shard_start", "shard", "shard_base", "start", "token_ids"} & set(metadata):
        raise ValueError(f"metadata columns are named like results: {sorted(taken)}; rename them first")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *metadata, F.col(text).alias("_text"))
    tie = F.xxhash64("_text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered = ordered.withColumn("shard", F.spark_partition_id())
    numbers = {name: F.lit(0).cast("long") for name in ("n_tokens", "shard_start")}
    schema = ordered.withColumns(numbers | {"token_ids": F.lit(None).cast("array<int>")}).drop("_text").schema
    names = [f.name for f in schema]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch, data, offsets in chunks(batches, "_text"):
            ids, counts = encode_chunk(vocabulary, data, offsets)
            ends = np.cumsum(counts + 1)
            with_end = np.full(int(ends[-1]), end_id, np.int32)
            with_end[ragged(ends - counts - 1, counts)] = ids
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(with_end))
            columns = {name: batch.column(name) for name in names if name in batch.schema.names}
            columns |= {"n_tokens": pa.array(counts + 1), "shard_start": pa.array(before + ends - counts - 1)}
            columns["token_ids"] = lists
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)
            before += int(ends[-1])

    return ordered.mapInArrow(encode, schema)


def write_token_files(docs: DataFrame, path: str, **options) -> None:
    """Writes the shards below ``path``/tokens and their index below ``path``/index."""
    encode_in_order(docs, **options).write.options(**FORMAT).parquet(f"{path}/tokens")
    spark = docs.sparkSession
    sums = (
        spark.read.parquet(f"{path}/tokens")
        .groupBy("shard")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    )
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    index = sums.withColumn("shard_base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    index.coalesce(1).write.parquet(f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``: the ids of all documents before each one."""
    index = spark.read.parquet(f"{path}/index").select("shard", "shard_base")
    rows = spark.read.parquet(f"{path}/tokens")
    return rows.join(broadcast_if_small(index), "shard").withColumn("start", F.col("shard_base") + F.col("shard_start"))


DIGEST_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def token_file_digests(stored: DataFrame) -> DataFrame:
    """The ids that stand in the files, reduced to their crc32."""
    bound_batches(stored.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, lists.offset * 4)
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            kept = [batch.column(k) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(digests, DIGEST_SCHEMA)


def token_files(docs: DataFrame) -> DataFrame:
    """Writes the files of all documents in the shared folder and reads them back as digests."""
    spark = docs.sparkSession
    path = new_shared_path(spark, "token-files")
    write_token_files(docs, path)
    return token_file_digests(read_token_files(spark, path))
