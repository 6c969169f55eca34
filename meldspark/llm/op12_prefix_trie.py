"""Prefix trie of conversations: a skeleton of splitter paths, and local sorted shards.

A conversation becomes its path: 16 bytes of digest for each turn, so a node of the trie is a prefix of paths. Paths are
sorted into shards by (path, conv_id) at splitters from a sample; the splitters are broadcast. A node lies in several
shards only if it is a prefix of a splitter, so the prefixes of the splitters are the skeleton, and a shard needs
to compare a path with the two splitters beside it to know its skeleton nodes. Every shard finishes all its other nodes alone, in one
pass over its sorted paths, and has partial sums for its skeleton nodes. Those are reduced by node, then handed up the
skeleton, which is bounded by the splitters' bytes.

Copies of one conversation differ in conv_id, so splitters part them as well. Who ends at a node is hashed in the shard; for skeleton
nodes the shards write the ids as blocks of text, which stream through one hash in order.

Defined cases: rows without conv_id are left out; a null role or text is empty, null turns come first; rows with equal turn
are ordered by the digest of role and text, and repeated rows are repeated turns; an empty table gives no node, not even a root; a
conversation without turns (possible after rebuilding) ends at the root; extra columns are ignored. Very long texts
leave 20 bytes a turn after the first projection; memory follows a shard or the longest conversation's turns.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldspark.llm.spans import bound_batches
from meldspark.session import broadcast_if_small, stage

WIDTH = 16  # bytes of a turn's digest
SHARD_BYTES = 16 << 20  # of paths
SHARD_ROWS = 1_000  # a shard of fewer conversations isn't worth a task
SAMPLES = 4  # for each shard
SAMPLE_BYTES = 32 << 20  # bound of what the driver samples; a quarter of it at most becomes splitters
BLOCK_IDS = 8_192
NOBODY = hashlib.sha256(b"").hexdigest()


def turns_by_conversation(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (turn, digest, size) in order; size is the UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).alias("size")).alias("t"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _path(turns: str | Column) -> list[Column]:
    digests = F.array_join(F.transform(turns, lambda t: F.hex(t.digest)), "")
    return [F.unhex(digests).alias("path"), F.transform(turns, lambda t: t.size).alias("sizes")]


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path, sizes of the conversations as they are."""
    return turns_by_conversation(conversations).select("conv_id", *_path("turns"))


def rebuilt_paths(conversations: DataFrame, family: int = 5, longest: int = 8) -> DataFrame:
    """conv_id, path, sizes with the first h turns of each conversation replaced by those of its family's first one
    (conv_id less conv_id modulo ``family``); h is the crc32 of the decimal conv_id modulo ``longest`` + 1."""
    own = turns_by_conversation(conversations)
    first = own.filter(F.pmod("conv_id", F.lit(family)) == 0)
    first = first.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, longest).alias("_first"))
    hashed = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    rows = own.withColumn("_base", F.col("conv_id") - F.pmod("conv_id", F.lit(family)))
    rows = rows.withColumn("_h", (hashed % (longest + 1)).cast("int")).join(first, "_base", "left")
    turns = F.expr(
        "concat(slice(coalesce(_first, slice(turns, 1, 0)), 1, _h), slice(turns, _h + 1, size(turns)))"
    )
    return rows.select("conv_id", turns.alias("turns")).select("conv_id", *_path("turns"))


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths have in common from the start."""
    most = min(len(a), len(b)) // WIDTH
    depth = 0
    while depth < most and a[depth * WIDTH : (depth + 1) * WIDTH] == b[depth * WIDTH : (depth + 1) * WIDTH]:
        depth += 1
    return depth


class Skeleton:
    """Sorted splitters (path, conv_id) and, for every prefix of each, the first splitter that has it."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.owners: list[np.ndarray] = []
        for k, (path, _) in enumerate(splitters):
            own = np.full(len(path) // WIDTH, k, np.int32)
            if k:
                shared = common_turns(path, splitters[k - 1][0])
                own[:shared] = self.owners[-1][:shared]
            self.owners.append(own)

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def depths(self, shard: int, path: bytes) -> tuple[int, int]:
        """How many turns a path of the shard has in common with the splitters before and behind it."""
        before = common_turns(path, self.splitters[shard - 1][0]) if shard else 0
        behind = common_turns(path, self.splitters[shard][0]) if shard < len(self.splitters) else 0
        return before, behind

    def owner(self, shard: int, before: int, depth: int) -> int:
        """The skeleton's name, beside its depth, of a node at ``depth``."""
        return int(self.owners[shard - 1 if depth <= before else shard][depth - 1]) if depth else 0


def choose_splitters(paths: DataFrame, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> list[tuple[bytes, int]]:
    """Splitters for shards of about ``shard_bytes``, and for all cores where shards keep ``shard_rows`` conversations."""
    bytes_of = F.octet_length("path") + 8
    rows, size = paths.agg(F.count(F.lit(1)), F.sum(bytes_of)).first()
    cores = paths.sparkSession.sparkContext.defaultParallelism
    shards = max(-(-(size or 0) // shard_bytes), min(2 * cores, rows // shard_rows), 1)
    if shards == 1:
        return []
    steps = 1 << 40
    part = min(steps, steps * SAMPLES * shards // rows + 1)
    draw = F.pmod(F.xxhash64("conv_id"), F.lit(steps))
    while (paths.filter(draw < part).agg(F.sum(bytes_of)).first()[0] or 0) > SAMPLE_BYTES:
        part //= 2
    sample = sorted((bytes(r.path), r.conv_id) for r in paths.filter(draw < part).select("path", "conv_id").collect())
    places = sorted({k * len(sample) // shards for k in range(1, shards)}) if sample else []
    return [sample[k] for k in places]


LOCAL_SCHEMA = (
    "kind int, conv_id long, depth long, parent_conv_id long, parent_owner int, owner int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, size long, ends_sha256 string, shard int, block long, ids string"
)
NODE, SKELETON, ENDS = range(3)


class _Shard:
    """The nodes of one shard, in the order of their first paths, and what its skeleton nodes' members are."""

    def __init__(self, number: int, skeleton: Skeleton):
        self.number, self.skeleton = number, skeleton
        self.parent, self.depth, self.size = array("q"), array("q"), array("q")
        self.least, self.members, self.owner = array("q"), array("q"), array("q")  # owner -1: not in the skeleton
        self.ends: dict[int, str] = {}
        self.blocks: list[tuple[int, int, str]] = []
        self.path = b""
        self.open = [self._node(-1, 0, 0, 0)]
        self.ending, self.ids = 0, array("q")

    def _node(self, parent: int, depth: int, size: int, owner: int) -> int:
        for field, value in (
            (self.parent, parent), (self.depth, depth), (self.size, size), (self.owner, owner),
            (self.least, (1 << 63) - 1), (self.members, 0),
        ):
            field.append(value)
        return len(self.parent) - 1

    def add(self, path: bytes, conv_id: int, sizes) -> None:
        shared = common_turns(path, self.path)
        turns = len(path) // WIDTH
        del self.open[shared + 1 :]
        if shared < turns:
            before, behind = self.skeleton.depths(self.number, path)
            for depth in range(shared + 1, turns + 1):
                inside = depth <= max(before, behind)
                owner = self.skeleton.owner(self.number, before, depth) if inside else -1
                self.open.append(self._node(self.open[-1], depth, sizes[depth - 1], owner))
        self.path = path
        node = self.open[-1]
        if node != self.ending:
            self._flush()
            self.ending = node
        self.ids.append(conv_id)
        self.members[node] += 1
        self.least[node] = min(self.least[node], conv_id)
        if self.owner[node] >= 0 and len(self.ids) == BLOCK_IDS:
            self._flush()

    def _flush(self) -> None:
        if self.ids:
            text = ",".join(map(str, self.ids))
            if self.owner[self.ending] >= 0:
                self.blocks.append((self.ending, len(self.blocks), text))
            else:
                self.ends[self.ending] = hashlib.sha256(text.encode()).hexdigest()
            self.ids = array("q")

    def rows(self) -> Iterator[pa.RecordBatch]:
        self._flush()
        parent, owner, members, least = self.parent, self.owner, self.members, self.least
        number = len(parent)
        children, leaves, saved = (array("q", bytes(8 * number)) for _ in range(3))
        for v in range(number - 1, 0, -1):
            p = parent[v]
            members[p] += members[v]
            least[p] = min(least[p], least[v])
            if owner[v] < 0:  # a skeleton node's own share is known only after the reduction
                leaves[v] = leaves[v] or 1
                saved[v] += (members[v] - 1) * self.size[v]
                children[p] += 1
                leaves[p] += leaves[v]
                saved[p] += saved[v]
        up = np.maximum(np.array(parent), 0)
        of = {name: np.array(x) for name, x in (("owner", owner), ("least", least))}
        inside = of["owner"] >= 0
        under = of["owner"][up] >= 0
        ends = [self.ends.get(v, NOBODY) for v in range(number)]
        for a in range(0, number, 100_000):
            b = min(a + 100_000, number)
            yield _local_batch(
                b - a,
                kind=np.where(inside, SKELETON, NODE)[a:b],
                conv_id=of["least"][a:b],
                depth=np.array(self.depth)[a:b],
                parent_conv_id=pa.array(of["least"][up][a:b], pa.int64(), mask=(under | inside)[a:b]),
                parent_owner=pa.array(of["owner"][up][a:b], pa.int32(), mask=~(under & ~inside)[a:b]),
                owner=of["owner"][a:b],
                n_convs=np.array(members)[a:b],
                n_children=np.array(children)[a:b],
                n_leaves=np.array(leaves)[a:b],
                saved_tokens=np.array(saved)[a:b],
                size=np.array(self.size)[a:b],
                ends_sha256=ends[a:b],
            )
        for node, block, text in self.blocks:
            yield _local_batch(
                1, kind=[ENDS], depth=[self.depth[node]], owner=[owner[node]], shard=[self.number], block=[block], ids=[text]
            )


_LOCAL_TYPES = {name: {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind] for name, kind in (
    field.split() for field in LOCAL_SCHEMA.split(", ")
)}


def _local_batch(rows: int, **columns) -> pa.RecordBatch:
    arrays = [
        pa.nulls(rows, kind) if name not in columns
        else columns[name] if isinstance(columns[name], pa.Array) else pa.array(columns[name], kind)
        for name, kind in _LOCAL_TYPES.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(_LOCAL_TYPES))


def _local_nodes(paths: DataFrame, skeleton) -> DataFrame:
    """The nodes of all shards, the shards' sums for skeleton nodes, and who ends at skeleton nodes."""
    schema = paths.selectExpr("*", "0 shard").schema

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = skeleton.value
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shards = pa.array([trie.shard(path, conv_id) for path, conv_id in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], schema.names)

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, shard = skeleton.value, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "sizes"))
            for number, path, conv_id, sizes in zip(*columns):
                if shard is None or shard.number != number:
                    if shard:
                        yield from shard.rows()
                    shard = _Shard(number, trie)
                shard.add(path, conv_id, sizes)
        if shard:
            yield from shard.rows()

    dealt = paths.mapInArrow(deal, schema).repartition("shard")
    return dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(nodes, LOCAL_SCHEMA)


def _streamed_ends(blocks: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) of skeleton nodes: the blocks of a node pass through one hash, in order."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, digest):
            arrays = [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([digest.hexdigest()])]
            return pa.RecordBatch.from_arrays(arrays, ["owner", "depth", "ends_sha256"])

        last, digest = None, None
        for batch in batches:
            for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ids"))):
                if (owner, depth) != last:
                    if digest:
                        yield row(last, digest)
                    last, digest = (owner, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if digest:
            yield row(last, digest)

    ordered = blocks.select("owner", "depth", "shard", "block", "ids").repartition("owner", "depth")
    ordered = ordered.sortWithinPartitions("owner", "depth", "shard", "block")
    return ordered.mapInArrow(hashes, "owner int, depth long, ends_sha256 string")


SKELETON_SCHEMA = (
    "owner int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def _skeleton_nodes(partial: DataFrame, skeleton) -> DataFrame:
    """The skeleton's nodes from the reduced sums of the shards; one task, as large as the splitters."""
    sums = partial.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("size").alias("size"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, rows = skeleton.value.owners, {}
        for batch in batches:
            for r in batch.to_pylist():
                rows[r["owner"], r["depth"]] = r
        for (owner, depth), r in sorted(rows.items(), key=lambda item: -item[0][1]):
            r["n_leaves"] = r["n_leaves"] or 1
            r["saved_tokens"] += (r["n_convs"] - 1) * r["size"] if depth else 0
            r["parent_conv_id"] = None
            if depth:
                p = rows[int(owners[owner][depth - 2]) if depth > 1 else 0, depth - 1]
                r["parent_conv_id"] = p["conv_id"]
                p["n_children"] += 1
                p["n_leaves"] += r["n_leaves"]
                p["saved_tokens"] += r["saved_tokens"]
        fields = [f.split() for f in SKELETON_SCHEMA.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[name] for r in rows.values()], types[kind]) for name, kind in fields], [name for name, _ in fields]
        )

    return sums.coalesce(1).mapInArrow(climb, SKELETON_SCHEMA)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id unique, path, sizes): ``COLUMNS``.

    A node is named by its smallest conv_id and its depth; n_leaves and saved_tokens are sums over its subtree.
    """
    bound_batches(paths.sparkSession)
    paths = stage(paths, "trie-paths")
    splitters = Skeleton(choose_splitters(paths, shard_bytes, shard_rows))
    skeleton = paths.sparkSession.sparkContext.broadcast(splitters)
    local = stage(_local_nodes(paths, skeleton), "trie-nodes")
    shared = stage(_skeleton_nodes(local.filter(F.col("kind") == SKELETON), skeleton), "trie-skeleton")
    ends = _streamed_ends(local.filter(F.col("kind") == ENDS))
    top = shared.join(ends, ["owner", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY)))
    nodes = local.filter(F.col("kind") == NODE)
    parents = shared.select(
        F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_parent")
    )
    below = nodes.filter("parent_owner IS NOT NULL").join(broadcast_if_small(parents), ["parent_owner", "depth"])
    below = below.withColumn("parent_conv_id", F.col("_parent"))
    inner = nodes.filter("parent_owner IS NULL")
    return top.select(COLUMNS).unionByName(below.select(COLUMNS)).unionByName(inner.select(COLUMNS))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt_paths(conversations))
