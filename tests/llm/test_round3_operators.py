"""Chunked BPE, the conversation trie and periodic runs, each against a brute-force version."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from meldspark.llm.op11_chunk_bpe import byte_bpe_decode, byte_bpe_digests, byte_bpe_encode
from meldspark.llm.op12_prefix_trie import (
    COLUMNS,
    NOBODY,
    Skeleton,
    choose_splitters,
    conversation_paths,
    conversation_trie,
    prefix_trie,
    rebuilt_paths,
)
from meldspark.llm.op13_periodic_runs import collapse_runs, periodic_runs, run_digests, with_planted_runs

SF_DIR = "/root/testdata/sf0.001"
WHITE = "".join(map(chr, (0x20, *range(0x09, 0x0E))))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\v "),
    (None, "no id here, only a few words, only a few words, only a few words, only a few words"),
    (4, "one"),
    (4, "one"),
    (4, "the same id, other text"),
    (5, "don't <|endoftext|> we've 'tis  double  spaces\n\n\tand tabs é中文 \U0001f600 x'''s 'll''ve" * 9),
    (6, "a b c a b c a b c a b c a b c d " * 40),
    (7, "a" * 3000 + " 1" * 40 + "\n" + "=" * 500 + "x" * 200 + "'" * 300 + "s" + " " * 400 + "y"),
    (8, "中文没有空格" * 300 + "、" + "かな" * 200 + "   z"),
    (9, "- " * 50 + "end " + "x y " * 30 + "x"),
    (10, "a\x00b \x1f c\x1cd e " * 12),
]
EXTRA = "ids string, runs string, bytes string, uid long, k long, part string, _keep long, head string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, "[1]", "r", "b", k, k, "p", k, "h") for k, r in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")


@pytest.fixture(scope="module")
def both(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- byte-level BPE over chunks ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"chunk": 64, "overlap": 24}, {"chunk": 700, "overlap": 40}])
def test_chunked_ids_are_the_librarys(both, library, sizes):
    def expected(text):
        ids = library.encode_ordinary(text or "")
        return len(ids), sha(" ".join(map(str, ids))), sha(library.decode_bytes(ids))

    rows = both.filter("doc_id IS NULL OR doc_id < 40")
    assert as_rows(byte_bpe_digests(rows, **sizes)) == Counter((r.doc_id, *expected(r.text)) for r in rows.collect())


def test_random_texts_in_small_chunks(spark, library):
    draw = random.Random(7)
    signs = ["a", "B", "é", "中", "1", "٣", " ", "  ", "\n", "\t", " ", "'", "'s", "'ll", "!", "-", "\U0001f600", "́"]
    rows = [(k, "".join(draw.choices(signs, k=draw.randrange(1, 400)))) for k in range(600)]
    rows += [(600 + k, sign * 300) for k, sign in enumerate(signs)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.ids for r in byte_bpe_encode(df, chunk=48, overlap=20).collect()}
    assert got == {k: library.encode_ordinary(text) for k, text in rows}


def test_round_trip_with_kept_columns(odd):
    encoded = byte_bpe_encode(odd, ("doc_id", "uid", "_keep", "part"), chunk=100, overlap=30)
    back = byte_bpe_decode(encoded, ("uid", "part"))
    assert back.columns == ["uid", "part", "bytes"]
    assert {r.uid: bytes(r.bytes).decode() for r in back.collect()} == {r.uid: r.text or "" for r in odd.collect()}


def test_results_columns_may_not_be_kept(odd):
    with pytest.raises(ValueError):
        byte_bpe_encode(odd, ("doc_id", "ids"))
    with pytest.raises(ValueError):
        periodic_runs(odd, ("runs",))
    with pytest.raises(ValueError):
        collapse_runs(odd, ("text",))


# --- conversation trie ------------------------------------------------------------------------------------------------


def rebuilt(rows):
    """conv_id -> list of (role, text); rows are (conv_id, turn, role, text)."""

    def key(row):
        digest = hashlib.sha256(f"{len(row[2] or '')}:{row[2] or ''}{row[3] or ''}".encode()).digest()[:16]
        return row[1] is not None, row[1] or 0, digest

    turns = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        turns[row[0]].append((row[2] or "", row[3] or ""))
    result = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        result[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return result


def brute_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows, leaves, saved = Counter(), {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = own + sum(saved[c] for c in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(paths[c]) == len(node))
        rows[
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(children[node]), leaves[node], saved[node], sha(ends),
        ] += 1
    return rows


SMALL = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, None, None, None), (0, 1, "user", "tie"), (0, 1, "user", "tie"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "é"), (2, 5, None, "x"), (3, 0, "", "x"),
    (4, 0, "user", ""), (None, 0, "user", "nobody"), (7, 0, "user", "no first one"), (7, 1, "user", "hi"),
    (12, 0, "userh", "i"), (13, 0, "user", "hi"),
    *((k, t, "user", "the same") for k in range(100, 400) for t in range(3 + k % 2)),
    *((500, t, "user", f"turn {t % 7}") for t in range(600)),
    *((505, t, "user", f"turn {t % 7}") for t in range(590)),
]


@pytest.fixture(scope="module")
def conversations(spark):
    given = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(F.col("conv_id") + 1000, "turn", "role", "text")
    small = spark.createDataFrame(SMALL, "conv_id long, turn long, role string, text string")
    return small.union(given).withColumns({name: F.lit("x") for name in ("path", "shard", "depth", "owner", "turns")})


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 2_000}, {"shard_bytes": 300}, {"shard_rows": 1 << 40}])
def test_trie_of_rebuilt_conversations(conversations, sizes):
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    got = prefix_trie(rebuilt_paths(conversations), **sizes)
    assert got.columns == COLUMNS
    assert as_rows(got) == brute_trie(rebuilt(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = [(k, t, "user", f"{k % 3 if t else 0}") for k in range(30) for t in range(1 + k % 4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    paths = defaultdict(list)
    for c, _, role, text in rows:
        paths[c].append((role, text))
    assert as_rows(prefix_trie(conversation_paths(df), shard_bytes=64)) == brute_trie(paths)


def test_trie_of_nothing(conversations):
    assert conversation_trie(conversations.filter("false")).count() == 0
    assert conversation_trie(conversations.filter("conv_id IS NULL")).count() == 0


def test_splitters_part_copies_of_one_conversation(conversations):
    copies = rebuilt_paths(conversations.filter("conv_id BETWEEN 100 AND 399"))
    skeleton = Skeleton(choose_splitters(copies, 1_000))
    shards = Counter(skeleton.shard(bytes(r.path), r.conv_id) for r in copies.collect())
    assert len(shards) > 5 and max(shards.values()) < 120


def test_ends_of_a_node_pass_in_blocks(spark, monkeypatch):
    import meldspark.llm.op12_prefix_trie as op

    rows = spark.range(40_000).selectExpr("id conv_id", "0L turn", "'user' role", "'same' text")
    got = prefix_trie(conversation_paths(rows), shard_bytes=100_000).collect()
    ends = {r.depth: r.ends_sha256 for r in got}
    assert op.BLOCK_IDS < 20_000 and ends == {0: NOBODY, 1: sha(",".join(map(str, range(40_000))))}


# --- periodic runs ----------------------------------------------------------------------------------------------------


def words_of(text):
    for sign in WHITE[1:]:
        text = (text or "").replace(sign, " ")
    return [w for w in text.split(" ") if w] if text else []


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted((start, size, q) for (start, size), q in found.items())


def by_start(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_run_digests_of_whole_table(both):
    short = both.filter("coalesce(length(text), 0) < 9000")
    expected = Counter()
    for r in short.collect():
        words = planted(r.doc_id, words_of(r.text))
        runs = by_start(brute_runs(words))
        best = (None,) * 4
        for start, size, q in runs:
            if best[0] is None or size * best[2] > best[1] * q:
                best = start, size, q, 1000 * size // q
        expected[(r.doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))] += 1
    got = as_rows(run_digests(with_planted_runs(short)))
    assert sum(k[1] > 0 for k in expected) > 10 and got == expected


def test_random_runs(spark):
    draw = random.Random(3)
    rows = []
    for k in range(400):
        n, kinds = draw.choice([5, 30, 150, 400, 1200]), draw.choice([1, 2, 3, 60])
        words = [draw.randrange(kinds) for _ in range(n)]
        for _ in range(draw.randrange(4)):
            a, e = draw.randrange(n), draw.randrange(n + 1)
            p = draw.randrange(1, (n - a) // draw.choice([3, 4, 5, 9]) + 2)
            for i in range(a, e):
                words[i] = words[a + (i - a) % p]
        rows.append((k, "\n".join(f"w{w}" for w in words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(df).collect()}
    expected = {k: by_start(brute_runs(text.split())) for k, text in rows}
    assert got == expected and sum(map(len, expected.values())) > 300
    assert any(q >= 64 for runs in expected.values() for _, _, q in runs)
    texts = {r.doc_id: r.text for r in collapse_runs(df).collect()}
    assert texts == {k: collapsed(text.split(), expected[k]) for k, text in rows}


def test_runs_of_odd_rows_with_kept_columns(odd):
    got = periodic_runs(odd, ("uid", "ids", "text"))
    assert got.columns == ["uid", "ids", "text", "runs"]
    assert all([tuple(x) for x in r.runs] == by_start(brute_runs(words_of(r.text))) for r in got.collect())
    assert periodic_runs(odd.filter("false")).count() == 0 and byte_bpe_encode(odd.filter("false")).count() == 0


def test_a_long_text_of_one_word_is_one_run(spark):
    df = spark.createDataFrame([(1, "la " * 300_000), (2, "la la " * 2 + "lo")], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(df).collect()}
    assert got == {1: [(0, 300_000, 1)], 2: []}
