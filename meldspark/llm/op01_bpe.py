"""BPE encoding and decoding: speculate and verify.

Greedy longest match proposes the tokens of every word that a worker hasn't seen. A split is the word's encoding
exactly if all its tokens encode to themselves and every adjacent pair encodes to itself, so the proposals of a
chunk are checked together against tables of known tokens and pairs; only words with a failing pair are merged
step by step. Spark deals out the rows; no shuffle is needed and a lost task is simply run again.

Defined cases: null text counts as empty and gives no ids; rows are independent, so repeated rows and ties need no
rule; an empty table gives an empty result; extra columns are ignored by ``bpe_encode`` unless named in ``keep``, and a kept
column with the name of a result column is refused. Very long texts: memory follows a chunk or the longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldspark.llm.pretokens import Splitter
from meldspark.llm.spans import SpanCache, bound_batches, chunks, ragged, row_sums
from meldspark.llm.tokenizer_files import load_tokenizer, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabulary files write for the 256 bytes."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    hidden = (b for b in range(256) if b not in set(shown))
    return letters | {chr(256 + k): b for k, b in enumerate(hidden)}


class Coder:
    """Encodes words given as bytes, and has the bytes of every id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        letters = byte_letters()
        vocabulary = model["model"]["vocab"]
        self.token_bytes: dict[int, bytes] = {
            i: t.encode() if t in special else bytes(letters[c] for c in t) for t, i in vocabulary.items()
        }
        self.token_bytes |= {t["id"]: t["content"].encode() for t in model["added_tokens"]}
        self.ids = {b: i for i, b in self.token_bytes.items() if b.decode("utf-8", "replace") not in special}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.longest: dict[bytes, int] = {}
        for b in self.ids:
            if len(b) > 2:
                self.longest[b[:3]] = max(self.longest.get(b[:3], 0), len(b))
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left], vocabulary[right]] = rank
            self.made.append(vocabulary[left + right])
        size = max(self.token_bytes) + 1
        self.lengths = np.zeros(size, np.int64)
        for i, b in self.token_bytes.items():
            self.lengths[i] = len(b)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.token_bytes.get(i, b"") for i in range(size)), np.uint8)
        self._own: dict[int, bool] = {}
        self._pairs = np.zeros(0, np.int64)
        self._fits = np.zeros(0, bool)

    def propose(self, word: bytes) -> list[int]:
        out, at, size, ids = [], 0, len(word), self.ids
        while at < size:
            end = min(at + self.longest.get(word[at : at + 3], 2), size)
            while (number := ids.get(word[at:end])) is None:
                end -= 1
            out.append(number)
            at = end
        return out

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost among equals."""
        symbols = [self.single[b] for b in word]
        if len(symbols) > 48:
            return self._merge_long(symbols)
        rank, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            symbols[k : k + 2] = [made[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((symbols[k - 1], symbols[k]), none)
            if k < len(ranks):
                ranks[k] = rank((symbols[k], symbols[k + 1]), none)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        size, ranks, made = len(symbols), self.ranks, self.made
        after, before = [*range(1, size), -1], [-1, *range(size - 1)]
        queue = [(r, k, p) for k, p in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(p)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, k, pair = heapq.heappop(queue)
            n = after[k]
            if n < 0 or symbols[k] < 0 or (symbols[k], symbols[n]) != pair:
                continue
            symbols[k], symbols[n] = made[rank], -1
            after[k] = after[n]
            if after[n] >= 0:
                before[after[n]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] >= 0:
                    p = symbols[left], symbols[after[left]]
                    if (r := ranks.get(p)) is not None:
                        heapq.heappush(queue, (r, left, p))
        return [s for s in symbols if s >= 0]

    def _own_encoding(self, token: int) -> bool:
        if token not in self._own:
            self._own[token] = self.merge(self.token_bytes[token]) == [token]
        return self._own[token]

    def _fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        codes, inverse = np.unique(left << 32 | right, return_inverse=True)
        place = np.searchsorted(self._pairs, codes)
        known = np.zeros(len(codes), bool)
        inside = place < len(self._pairs)
        known[inside] = self._pairs[place[inside]] == codes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            fits = [
                self._own_encoding(a) and self._own_encoding(b)
                and self.merge(self.token_bytes[a] + self.token_bytes[b]) == [a, b]
                for a, b in ((c >> 32, c & 0xFFFFFFFF) for c in codes[new].tolist())
            ]
            self._fits = np.insert(self._fits, place[new], fits)
            self._pairs = np.insert(self._pairs, place[new], codes[new])
            place = np.searchsorted(self._pairs, codes)
        return self._fits[place][inverse]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        proposed = [self.propose(w) for w in words]
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        tokens = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        adjacent = np.flatnonzero(owner[1:] == owner[:-1])
        failing = set(owner[adjacent[~self._fitting(tokens[adjacent], tokens[adjacent + 1])]].tolist())
        alone = np.flatnonzero(lengths == 1)
        failing.update(k for k in alone.tolist() if not self._own_encoding(proposed[k][0]))
        for k in failing:
            proposed[k] = self.merge(words[k])
        return proposed

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and how many each has."""
        lengths = self.lengths[ids]
        return self.bytes[ragged(self.starts[ids], lengths)], lengths


_WORKER: dict[str, tuple[Coder, Splitter, SpanCache]] = {}


def _worker(vocabulary: str) -> tuple[Coder, Splitter, SpanCache]:
    if vocabulary not in _WORKER:
        _WORKER[vocabulary] = Coder(vocabulary_path(vocabulary)), Splitter(load_tokenizer(vocabulary)), SpanCache()
    return _WORKER[vocabulary]


def encode_chunk(vocabulary: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows of a chunk, one row after the other, and offsets of the rows."""
    coder, splitter, cache = _worker(vocabulary)
    starts, ends, rows, special = splitter.spans(data, offsets)
    plain = special < 0
    slots = cache.slots_of(data, starts[plain], ends[plain], coder.encode_words)
    counts = np.ones(len(starts), np.int64)
    counts[plain] = cache.lengths[slots]
    ids = np.empty(int(counts.sum()), np.int32)
    if plain.all():
        ids = cache.expand(slots)
    else:
        first = np.cumsum(counts) - counts
        ids[ragged(first[plain], counts[plain])] = cache.expand(slots)
        ids[first[~plain]] = special[~plain]
    totals = row_sums(counts, rows, len(offsets) - 1)
    return ids, np.concatenate([[0], np.cumsum(totals)])


def decode_lossy(raw: bytes) -> bytes:
    """UTF-8 of the text that the bytes stand for; broken sequences become U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def bpe_encode(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Columns ``keep``, then ``ids`` array<int>: the ids of every whole text."""
    if "ids" in keep:
        raise ValueError("a kept column is named ids; rename it first")
    bound_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = rows.select(*keep, F.lit(None).cast("array<int>").alias("ids")).schema

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "_text"):
            ids, row_offsets = encode_chunk(vocabulary, data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(row_offsets, pa.int32()), pa.array(ids, pa.int32()))
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, lists], [f.name for f in schema])

    return rows.mapInArrow(encode, schema)


def bpe_decode(encoded: DataFrame, keep: Sequence[str] = ("doc_id",), ids: str = "ids", vocabulary: str = VOCABULARY):
    """Columns ``keep``, then ``text``: the decoded text; null ids give an empty one."""
    if "text" in keep:
        raise ValueError("a kept column is named text; rename it first")
    rows = encoded.select(*keep, F.col(ids).alias("_ids"))
    schema = rows.select(*keep, F.lit("").alias("text")).schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(vocabulary)[0]
        for batch in batches:
            for row in range(0, batch.num_rows, 512):
                part = batch.slice(row, 512)
                texts = []
                for value in part.column(part.num_columns - 1):
                    own = np.array(value.as_py() or [], np.int64)
                    texts.append(decode_lossy(coder.decode(own)[0].tobytes()).decode())
                kept = [part.column(k) for k in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], [f.name for f in schema])

    return rows.mapInArrow(decode, schema)


DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_digests(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Every whole text encoded, decoded again, and both reduced to digests in the same task."""
    bound_batches(docs.sparkSession)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _worker(vocabulary)[0]
        for batch, data, offsets in chunks(batches, "_text"):
            ids, row_offsets = encode_chunk(vocabulary, data, offsets)
            decoded, lengths = coder.decode(ids)
            byte_ends = np.concatenate([[0], np.cumsum(lengths)])[row_offsets]
            raw, text_bytes = memoryview(ids.astype("<u4").tobytes()), decoded.tobytes()
            sha = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(row_offsets, row_offsets[1:])]
            back = [
                hashlib.sha256(decode_lossy(text_bytes[a:b])).hexdigest() for a, b in zip(byte_ends, byte_ends[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(row_offsets), pa.int64()), pa.array(sha, pa.string()),
                 pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(digests, DIGEST_SCHEMA)
