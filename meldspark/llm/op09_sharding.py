"""Sharding by proportional stratified interleaving.

Inside each source the rows are ranked in a seeded shuffle. A rank divided by the size of its source says how far through
the source a row lies; sorted by this share all sources advance together, so any cut of the sequence has the
mixture of the whole table. The sequence is cut into shards whose row counts differ by one at most.

Ranks and places come from range sorts over (source, hash) and (share, source, rank): a source with a third of all
rows is spread over many tasks, and numbers follow from running totals per task. Only ids, sizes and checksums move.

Defined cases: a null text has size 1 and checksum 0; a null source is a source of its own; equal rows are
interchangeable, equal doc_ids with other texts are ordered by the text's hash; an empty table gives an empty
result, fewer rows than shards leave the last places empty; extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.session import broadcast_if_small, stage
from meldspark.sources.numbering import number_in_order

SHARDS = 8
SEED = 20_260


def interleaved(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, place): ``place`` counts from 0 through the interleaved sequence."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("shuffled"),
    )
    numbered = stage(number_in_order(rows, ["source", "shuffled", "doc_id"], "number"), "ranked")
    sizes = numbered.groupBy("source").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("rows"))
    sizes = sizes.select(F.col("source").alias("of"), "first", "rows")
    share = (2 * (F.col("number") - F.col("first")) + 1) / (2 * F.col("rows"))
    shared = numbered.join(broadcast_if_small(sizes), F.col("source").eqNullSafe(F.col("of"))).withColumn("share", share)
    shared = shared.select("doc_id", "size", "text_crc32", "share", "number")
    placed = number_in_order(shared, ["share", "number"], "place")
    return placed.select("doc_id", "size", "text_crc32", (F.col("place") - 1).alias("place"))


def shards(docs: DataFrame, count: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``rows``."""
    placed = interleaved(docs, seed)
    total = F.lit(max(docs.count(), 1)).cast("long")
    shard = F.expr(f"place * {count}").cast("long")
    shard = F.floor(shard / total.cast("decimal(20,0)")).cast("int")
    rows = placed.withColumn("shard", shard)
    first = F.ceil(F.col("shard").cast("long") * total / F.lit(count).cast("decimal(20,0)")).cast("long")
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

