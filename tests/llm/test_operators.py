"""Each operator against a brute-force version, on the smallest tables and on a table of odd rows."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from meldspark.llm.op01_bpe import bpe_decode, bpe_digests, bpe_encode
from meldspark.llm.op02_token_files import encode_in_order, read_token_files, token_files, write_token_files
from meldspark.llm.op03_quality_classifier import co_train, quality_scores
from meldspark.llm.op04_quality import keep_good, quality_rules
from meldspark.llm.op05_simhash import near_duplicate_rows, one_of_each_group
from meldspark.llm.op06_pii import pii_spans, sanitised
from meldspark.llm.op07_html import extract_text, main_text
from meldspark.llm.op08_decontamination import contaminated_documents, contamination, remove_contaminated
from meldspark.llm.op09_sharding import shards
from meldspark.llm.op10_token_counts import token_counts
from meldspark.llm.tokenizer_files import load_tokenizer

SF_DIR = "/root/testdata/sf0.001"
LONG = "Words of a very long text, again and again 192.168.0.1 or a.b@c.example. " * 600
EXTRA = "row string, uid long, fp long, component_id long, kept string, n_words int, shard int, key string, ids string, label double"
ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n\v ", None, None, None),
    (None, "no id here, only a few words", "en", "a", 5),
    (4, "one", None, "b", 3),
    (4, "one", None, "b", 3),
    (4, "the same id, other text", "xx", "b", 3),
    (5, "don't <|endoftext|> we've 'tis  double  spaces\n\n\tand tabs é中文 \U0001f600 x" * 3, "fr", "c", 9),
    (6, LONG, "en", "a", len(LONG)),
    (7, "mail x.y+z@mail.example.com, 10.0.0.255 or 10.0.0.256, 4539 1488 0343 6467, +1 (499) 555-6503 end.", "en", "c", 1),
    (8, "a" * 3000 + " 1" * 40 + "\n" + "=" * 500, "en", "c", 1),
    (9, "one  ONE\none\none\ntwo a b c d e f a b c d e f", "en", None, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, f"{k}", k, k, k, "no", k, 0, "k", "[1]", 0.5) for k, r in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def both(odd, docs):
    """All given documents and the odd ones."""
    return docs.unionByName(odd.select(docs.columns))


def as_rows(df):
    return Counter(tuple(r) for r in df.collect())


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_bpe_digests_are_the_librarys(both):
    library = load_tokenizer("byte_bpe_50k.json")

    def expected(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    assert as_rows(bpe_digests(both)) == Counter((i, *expected(t)) for i, t in texts(both))


def test_bpe_round_trip(odd):
    back = bpe_decode(bpe_encode(odd, ("doc_id", "fp")), ("doc_id", "fp"))
    assert {r.fp: r.text for r in back.collect()} == {r.fp: r.text or "" for r in odd.collect()}


def test_merging_long_words_agrees_with_short_ones():
    from meldspark.llm.op01_bpe import _worker

    coder = _worker("byte_bpe_50k.json")[0]
    for word in (b"thereandouingtion" * 4, b"aaaa" * 30, b" =====" * 12):
        symbols = [coder.single[b] for b in word]
        library = load_tokenizer("byte_bpe_50k.json").model.tokenize(
            load_tokenizer("byte_bpe_50k.json").pre_tokenizer.pre_tokenize_str("x" + word.decode().strip())[0][0][1:]
        )
        assert coder._merge_long(symbols[:40]) == coder.merge(word[:40])
        if b" " not in word:
            assert coder.merge(word) == [t.id for t in library]


def test_token_files(both):
    library = load_tokenizer("word_bpe_49k.json")
    got = sorted(token_files(both).collect(), key=lambda r: r.start)
    ids = {}
    for i, t in texts(both):
        own = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        ids.setdefault(i, []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted(ids, key=lambda i: (i is not None, i)) == list(dict.fromkeys(r.doc_id for r in got))
    start = 0
    for r in got:
        assert r.start == start
        ids[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert not any(ids.values())


def test_token_files_are_encoded_and_indexed(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    write_token_files(docs, str(tmp_path), metadata=("source",))
    assert read_token_files(spark, str(tmp_path)).select("doc_id", "source", "start").count() == docs.count()
    file = next((tmp_path / "tokens").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    by_name = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert any("DICTIONARY" in e for e in by_name["token_ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in by_name["shard_start"].encodings
    assert by_name["doc_id"].has_column_index and by_name["doc_id"].has_offset_index


def test_token_counts(both):
    library = load_tokenizer("byte_bpe_50k.json")

    def expected(text):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        return len((text or "").encode()), n, n > 512

    assert as_rows(token_counts(both)) == Counter((i, *expected(t)) for i, t in texts(both))


def test_frequent_pretokens_of_whole_table(spark):
    """Tier one covers all rows and whole texts: late rows, ends of long texts; and it is bounded with guaranteed entries."""
    from meldspark.llm.op10_token_counts import Summary, frequent_lengths
    from meldspark.llm.spans import span_hashes, text_bytes

    def hashed(words):
        data, offsets = text_bytes(pa.array(words, pa.string()))
        return span_hashes(data, offsets[:-1], offsets[1:])

    early = [f"early{i} filler" for i in range(1500)]
    rows = [*early, "x" * 9000 + " tailword tailword", *["lateword lateword" for _ in range(40)], None, ""]
    docs = spark.createDataFrame([(t,) for t in rows], "text string").repartition(7)
    hashes, lengths = frequent_lengths(docs)
    tokenizer = load_tokenizer("byte_bpe_50k.json")
    for word in (" lateword", "lateword", " tailword", " filler"):
        place = np.searchsorted(hashes, hashed([word])[0])
        assert hashes[place] == hashed([word])[0]
        assert lengths[place] == len(tokenizer.encode(word, add_special_tokens=False).ids)
    few, _ = frequent_lengths(docs, size=8)
    assert len(few) <= 8 and hashed([" filler"])[0] in few
    assert [len(x) for x in frequent_lengths(docs.limit(0))] == [0, 0]

    draws = np.random.default_rng(5).zipf(1.3, 40_000) % 5_000
    exact = np.bincount(draws)
    merged = Summary(100)
    for part in np.array_split(np.sort(draws), 9):  # sorted: every part has other keys
        own = Summary(100)
        for chunk in np.array_split(part, 5):
            keys, counts = np.unique(chunk, return_counts=True)
            own.add(keys.astype(np.uint64), counts, keys)
        merged.add(own.keys, own.counts, own.values)
    assert len(merged.keys) <= 100 and (merged.keys == merged.values).all()
    assert set(np.flatnonzero(exact > len(draws) / 100)) <= set(merged.keys.tolist())
    assert all(0 <= exact[k] - n <= len(draws) / 100 for k, n in zip(merged.keys.tolist(), merged.counts.tolist()))


def test_classifier_learns_quality(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    unseen = labels.filter("doc_id % 4 = 1")
    scores = quality_scores(docs, labels.filter("doc_id % 4 <> 1"))
    rows = scores.join(unseen, "doc_id").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows)
    assert len(rows) > 500 and right / len(rows) >= 0.98
    good = [r for r in rows if r.quality == 1]
    assert sum(r.kept for r in good) / len(good) >= 0.98


def test_classifier_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.score, r.kept) for r in quality_scores(odd, none).collect()} == {(0.5, True)}
    labels = spark.createDataFrame([(1, 0), (1, 1), (4, 1), (7, 0), (None, 1)], "doc_id long, quality int")
    assert quality_scores(odd, labels).count() == len(ODD)


def test_co_training_uses_the_other_views_labels():
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400).astype(float)
    views = [rng.normal(size=(400, 4)) + 3 * y[:, None] for _ in range(2)]
    pool_y = rng.integers(0, 2, 300)
    pool = tuple(rng.normal(size=(300, 4)) + 3 * pool_y[:, None] for _ in range(2))
    model = co_train(tuple(views), y, pool)
    assert ((model.score(*pool)[2] > 0.5) == (pool_y == 1)).mean() > 0.98


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def base_counts(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    covered = {p for i, x in enumerate(windows) if often[x] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(w)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def histogram(text, common):
    t = text or ""
    classes = [
        sum(c.isascii() and c.isupper() for c in t), sum(c.isascii() and c.isdigit() for c in t),
        sum(c in ".,;:!?'\"()-" for c in t),
        sum("!" <= c <= "~" and not c.isalnum() and c not in ".,;:!?'\"()-" for c in t), sum(not c.isascii() for c in t),
    ]
    w = [x.lower() if len(x) <= 5 else None for x in words(t)]
    counts = [w.count(c) for c in common]
    return [*classes, sum(map(len, words(t))) - sum(classes)], [*counts, len(w) - sum(counts)]


def distance(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x > 0)
    return math.sqrt(max((half(p, q) + half(q, p)) / 2, 0))


def test_quality_rules(both):
    from meldspark.llm import op04_quality as op

    rows = [(r.doc_id, r.text, r.lang or "") for r in both.collect()]
    common, references = {}, {}
    for lang in {r[2] for r in rows}:
        short = Counter(w.lower() for r in rows if r[2] == lang for w in words(r[1]) if len(w) <= op.COMMON_CHARS)
        common[lang] = [w for w, _ in sorted(short.items(), key=lambda x: (-x[1], x[0]))[: op.COMMON_WORDS]]
        of = [histogram(r[1], common[lang]) for r in rows if r[2] == lang]
        references[lang] = [[sum(x) for x in zip(*part)] for part in zip(*of)]
    expected = Counter()
    for i, text, lang in rows:
        n, chars, *rest, failed = base_counts(text)
        classes, counts = histogram(text, common[lang])
        kept = not failed
        if sum(references[lang][1]) >= op.MIN_REFERENCE_WORDS:
            if chars >= op.MIN_CHARS_JUDGED:
                kept &= distance(classes, references[lang][0]) <= op.MAX_CLASS_DISTANCE
            if n >= op.MIN_WORDS_JUDGED:
                kept &= distance(counts, references[lang][1]) <= op.MAX_WORD_DISTANCE + op.WORD_SCATTER / math.sqrt(n)
        expected[i, n, chars, *rest, failed, kept] += 1
    assert as_rows(quality_rules(both).drop("class_distance", "word_distance")) == expected


def test_quality_rules_keep_columns(odd):
    kept = keep_good(odd)
    assert kept.columns == odd.columns
    verdicts = quality_rules(odd.select(F.col("fp").alias("doc_id"), "text", "lang")).filter("kept")
    assert {r.fp for r in kept.collect()} == {r.doc_id for r in verdicts.collect()}


def fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, ids):
    """component id of every row, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    groups = {}
    for k, i in enumerate(ids):
        groups.setdefault(find(k), []).append(i)
    smallest = {g: min((i for i in members if i is not None), default=None) for g, members in groups.items()}
    return [smallest[find(k)] for k in range(len(prints))]


def test_simhash(both):
    rows = texts(both)
    prints = [fingerprint(t) for _, t in rows]
    ids = linked(prints, [i for i, _ in rows])
    expected = Counter((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, ids))
    assert as_rows(near_duplicate_rows(both)) == expected


def test_one_row_of_each_group_stays(odd):
    rows = [(r.fp, r.doc_id, fingerprint(r.text)) for r in odd.collect()]
    groups = linked([r[2] for r in rows], [r[1] for r in rows])
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    kept = kept.collect()
    assert len(kept) == len(set(groups)) == len({groups[r.fp] for r in kept})
    assert all(r.doc_id == groups[r.fp] for r in kept)


@pytest.mark.parametrize("max_run", [2, 8, 8192])
def test_links_of_fingerprints_are_complete(spark, max_run):
    from meldspark.llm.op05_simhash import components, fingerprint_links

    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    prints = set()
    for centre in centres:
        for _ in range(60):
            flips = rng.integers(0, 64, rng.integers(0, 8))
            prints.add(int(centre) ^ sum({1 << int(b) for b in flips}))
    prints = sorted(prints)
    expected = linked(prints, prints)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = {r.node: r.root for r in components(fingerprint_links(df, max_run)).collect()}
    groups, got = {}, {}
    for s, e in zip(signed, expected):
        groups.setdefault(e, set()).add(s)
        got.setdefault(found.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_golay_code_is_perfect():
    from meldspark.llm.op05_simhash import Golay

    code = Golay()
    values = np.random.default_rng(2).integers(0, 1 << 23, 2000)
    index = code.index(values)
    own = values ^ code.error[code.low[values & 0xFFF] ^ code.high[values >> 12]]
    assert (np.bitwise_count(own ^ values) <= 3).all() and (code.index(own) == index).all()
    position, keys = code.nearby(values, 23)
    assert set(np.bincount(position).tolist()) <= {1, 6}


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    result = {}
    for kind, pattern in KINDS.items():
        result[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                result[kind].append(f"{kind}:{m.start()}:{m.end()}")
    return result


TRICKY = [
    "a@b.c@d.e a@b.c_x@d.e._%x@y.z- @@a@b.c .@.a b@c..d e@f.g.",
    "1.2.3.4.5.6.7.8 01.002.0003.255 256.1.1.1 1.2.3 1...2.3.4 \U0001f600 9.9.9.9",
    "4539 1488 0343 6467 4539-1488-0343-6467 4539148803436467 4539  1488 12345678901234567890 7992739871 3 +4539148803436467",
    "+1 (499) 555-6503 +123 +12345678 +1 +(1) 555 +1.2.3.4.5.6.7.8 +1234567890123456 ++49 30 1234567 ",
]


def test_pii_base_spans(spark, both):
    tricky = spark.createDataFrame([(9000 + k, t) for k, t in enumerate(TRICKY)], "doc_id long, text string")
    rows = both.select("doc_id", "text").union(tricky)
    expected = Counter()
    for i, text in texts(rows):
        spans = base_spans(text)
        listed = ",".join(s for kind in KINDS for s in spans[kind])
        expected[i, *(len(spans[k]) for k in KINDS), hashlib.sha256(listed.encode()).hexdigest()] += 1
    found = pii_spans(rows)
    assert as_rows(found.drop("spans", "n_term")) == expected
    for r in found.collect():
        base = [s for s in r.spans.split(",") if s and not s.startswith("term:")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_pii_terms_that_reveal_an_entity(spark):
    rows = [(k, f"plain text {k} about nothing in common{k} of note", "") for k in range(40)]
    rows += [(100 + k, f"filler{k} Zorblatt writes as z@q.example then{k} and the common words", "") for k in range(4)]
    rows += [(200 + k, "copies Onceler mailed o@q.example as ever", "") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in pii_spans(docs).collect()}
    for k in range(4):
        text = rows[40 + k][1]
        at = text.index("Zorblatt")
        assert f"term:{at}:{at + 8}" in found[100 + k].spans.split(",")
        assert f"filler{k}" in text and found[100 + k].n_email == 1
    assert all(found[200 + k].n_term == 0 for k in range(5))  # copies are one piece of evidence
    assert all(found[k].spans == "" for k in range(40))
    clean = {r.doc_id: r.text for r in sanitised(docs).collect()}
    assert clean[100].startswith("filler0 [TERM]") and "z@q.example" not in clean[100] and "[EMAIL]" in clean[100]
    assert clean[5] == rows[5][1]


def test_pii_terms_are_marked_at_every_place(spark):
    far = "one of many plain words, " * 8
    rows = [(k, f"one of many plain words, number{k}") for k in range(60)]
    rows += [(100 + k, f"Zorblatt {far}filler{k} zorblatt writes{k} as z@q.example then{k}") for k in range(3)]
    rows += [(110, f"ZORBLATT {far}z@q.example"), (111, f"Of Zorblatt, {far}no mails. Zorblatts 9zorblatt"), (112, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii_spans(docs).collect()}
    for i, text in rows[60:]:
        places = [m.span() for m in re.finditer(r"[^\W\d_]\w{2,}", text or "") if m[0].lower() == "zorblatt"]
        assert [s for s in found[i].split(",") if s.startswith("term:")] == [f"term:{a}:{b}" for a, b in places]
    clean = {r.doc_id: r.text for r in sanitised(docs).collect()}
    assert clean[100].startswith("[TERM] one of") and "filler0 [TERM] writes0 as [EMAIL]" in clean[100]
    assert clean[110].startswith("[TERM] one of") and clean[111].startswith("Of [TERM], one") and clean[112] is None


def test_pii_terms_need_two_independent_texts(spark):
    far = "one of many plain words, " * 8
    rows = [f"one of many plain words, number{k}" for k in range(40)]
    rows += ["Zorblatt writes0 as z@q.example then0", "later1 z@q.example is Zorblatt with1"]  # beside in both texts
    rows += [f"Truffula says2 t@q.example to2 {far}", f"Truffula {far}words3 t@q.example to3"]  # far away in one
    rows += [f"Onceler mailed o@q.example as ever {far}{x}" for x in ("near4", "near5", "near5")]  # copies and near copies
    rows += ["Lorax and6 l@q.example or7 l@q.example Lorax"]  # twice in one text
    rows += ["Sneetch has8 s@q.example now8", "some9 s@q.example Sneetch now9"] + ["the Sneetch elsewhere"] * 3
    rows += ["a0 Grinch has0 g@q.example n0", "some1 g@q.example Grinch n1"] + [f"Grinch not here{k}" for k in range(9)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {}
    for r in pii_spans(docs).collect():
        places = [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term:")]
        found[r.doc_id] = [rows[r.doc_id][int(a) : int(b)] for a, b in places]
    assert found[40] == found[41] == ["Zorblatt"] and found[42] == found[43] == ["Truffula"]
    assert all(not found[k] for k in [*range(40), 44, 45, 46, 47, *range(53, 64)])
    assert [found[k] for k in range(48, 53)] == [[]] * 5  # copies elsewhere are one text, but two of three is too little


def test_pii_terms_of_entities_that_stand_several_times(spark):
    """Texts that share one place of an entity, word for word, and have another one each are independent; near copies are not."""
    far = "one of many plain words, " * 8
    rows = [f"one of many plain words, number{k}" for k in range(200)]
    for k in range(16):
        same = f"Zorb{k} mailed m{k}@q.example as ever"
        rows += [f"{same} {far}first{k} m{k}@q.example here", f"{same} {far}then m{k}@q.example second{k}"]
        rows += [f"Onceler{k} mailed o{k}@q.example as ever {far}then o{k}@q.example now {far}{x}" for x in ("near1", "near2")]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii_spans(docs).collect()}
    for i, text in enumerate(rows):
        terms = [s.split(":")[1:] for s in found[i].split(",") if s.startswith("term:")]
        assert [text[int(a) : int(b)] for a, b in terms] == re.findall(r"Zorb\d+", text)


def test_pii_of_a_text_with_very_many_matches(spark):
    """A hundred thousand addresses in one text: linear, and equal to brute force."""
    text = " ".join(f"u{i}@x{i % 7}.example" if i % 3 else f"10.{i % 300}.0.{i % 256} é" for i in range(100_000))
    df = spark.createDataFrame([(1, text, len(text), "x")], "doc_id long, text string, n_chars long, _blocks string")
    started = time.monotonic()
    found = pii_spans(df).first()
    spans = base_spans(text)
    assert (found.n_email, found.n_ip) == (len(spans["email"]), len(spans["ip"])) and found.n_ip > 20_000
    assert found.spans == ",".join(s for kind in ("email", "ip", "card", "phone") for s in spans[kind])
    clean = sanitised(df).first()
    marks = sorted((int(a), int(b), f"[{kind.upper()}]") for own in spans.values() for kind, a, b in (s.split(":") for s in own))
    expected, at = [], 0
    for a, b, mark in marks:
        expected += [text[at:a], mark]
        at = b
    assert clean.text == "".join(expected) + text[at:] and clean.n_chars == len(clean.text) and clean._blocks == "x"
    assert time.monotonic() - started < 120


def brute_terms(texts):
    """The disclosing terms of texts in each of which an address stands once at most; straight from the definition."""
    entity_of, words, beside, context = {}, {}, {}, {}
    for t in set(texts):
        words[t] = set(re.findall(r"[a-z][a-z0-9]{2,}", t))
        if found := re.search(r"[a-z0-9.]+@[a-z0-9.]+[a-z0-9]", t):
            entity_of[t] = found[0]
            context[t] = t[max(0, found.start() - 60) : found.start()], t[found.end() : found.end() + 60]
            before, after = context[t]
            beside[t] = set(re.findall(r"(?<![a-z0-9])[a-z][a-z0-9]{2,}", before if len(before) < 60 else " " + before.split(" ", 1)[-1]))
            beside[t] |= set(re.findall(r"(?<![a-z0-9])[a-z][a-z0-9]{2,}", after if len(after) < 60 else after.rsplit(" ", 1)[0]))
    total, terms = len(set(texts)), set()
    for entity in set(entity_of.values()):
        own = [t for t in entity_of if entity_of[t] == entity]
        if len({context[t] for t in own}) < 2 or len(own) == total:
            continue
        information = math.log2(total / len(own))
        for term in set().union(*(beside[t] for t in own)):
            both = [t for t in own if term in words[t]]
            with_term = sum(term in w for w in words.values())
            if len({context[t] for t in both}) >= 2 and math.log2(total * len(both) / (with_term * len(own))) >= 0.9 * information:
                terms.add(term)
    return terms


@pytest.mark.parametrize("seed", [1, 2])
def test_pii_terms_are_those_of_the_definition(spark, seed):
    draw = random.Random(seed)
    names = [f"name{k}" for k in range(12)]
    texts = []
    for _ in range(300):
        words = draw.choices([f"word{k}" for k in range(60)], k=draw.randrange(3, 40))
        if draw.random() < 0.4:
            who = draw.randrange(12)
            at = draw.randrange(len(words))
            near = [names[who]] if draw.random() < 0.7 else [draw.choice(names)] if draw.random() < 0.3 else []
            words[at:at] = [*near, f"mail{who}@host{who % 4}.example"]
        elif draw.random() < 0.1:
            words.append(draw.choice(names))
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute_terms(texts)
    found = {texts[r.doc_id][int(a) : int(b)] for r in pii_spans(df).collect() for kind, a, b in (s.split(":") for s in r.spans.split(",") if s) if kind == "term"}
    assert found == expected and 0 < len(expected) < 12


def test_sanitised_keeps_rows_and_columns(odd):
    result = sanitised(odd)
    assert result.schema == odd.schema or result.columns == odd.columns
    before, after = ({r.fp: r for r in df.collect()} for df in (odd, result))
    assert before.keys() == after.keys()
    assert after[9].text == (
        "mail [EMAIL], [IP] or 10.0.0.256, [CARD], [PHONE] end."
    ) and after[9].n_chars == len(after[9].text)
    assert after[0].text is None and after[1].text == "" and after[0].n_chars == 0


PAGE = (
    '<html><head><title>No</title><style>p{}</style></head><body><header>Top</header><nav><a href="/">Home</a></nav>'
    '<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><article><h1>Head &amp; line</h1>'
    "<p>First <b>para</b>graph\n with&nbsp;space.<aside>Side</aside><p>Ok.<form><label>Name</label></form>"
    '<p>Last &lt;one&gt;.</article><section id="comments"><p>Nice</p></section><footer>&copy;</footer></body></html>'
)


def test_html_text():
    expected = "Head & line\nFirst paragraph with space.\nOk.\nLast <one>."
    assert main_text(PAGE) == expected
    assert main_text(PAGE.replace("article>", "div>")) == expected
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<script>x") == ""
    assert main_text("just text") == "just text"
    menu = "<div><ul><li><a>One</a></li><li><a>Two</a></li></ul></div>"
    assert main_text(f"<body>{menu}<div><div><div><p>Short.</p></div></div></div></body>") == "Short."


@pytest.mark.parametrize("cut", range(3, len(PAGE), 17))
def test_cut_pages_give_what_stands_before_the_cut(cut):
    whole = main_text(PAGE)
    got = main_text(PAGE[:cut])
    assert whole.startswith(got.rstrip("&ampltg;")) or got.replace("&l", "") in whole or "&" in got


LINKED = '<a href="/x">some linked words and more</a> '
LONG_TEXT = "One sentence of the text, and a second one. " * 6


@pytest.mark.parametrize("page, expected", [
    # A whole article stays, however many links it has; an anchor is no link, and a link ends with its block.
    (f"<article><h1>Head</h1><p>{LINKED * 3}end</p><ul><li>{LINKED}</ul></article>", "Head\n" + "some linked words and more " * 3 + "end\nsome linked words and more"),
    ("<article><a name=top><p>Long paragraph of text.</p><p>More.</p></article>", "Long paragraph of text.\nMore."),
    (f"<div><p><a href=/>Open link<p>{LONG_TEXT}</p></div>", LONG_TEXT.strip()),
    # Parts of names, paragraphs and headings are no reason to strip; names made of such words only are.
    ("<p class='market-share'>Share</p><div class='page-header'><h1>Title</h1></div><div class='notice-of-meeting'>Noon</div>", "Share\nTitle\nNoon"),
    (f"<p class=notice>First</p><h2 id=footer>Head</h2><p>{LONG_TEXT}</p>", f"First\nHead\n{LONG_TEXT.strip()}"),
    (f"<div class='site-header'>Site</div><div><p>{LONG_TEXT}</p></div><div id='cookie-banner2'>{LONG_TEXT}</div>", LONG_TEXT.strip()),
    (f"<div class=notice><article><p>Text</p></article></div><div class='comment list'><p>{LONG_TEXT}</p></div>", "Text"),
    (f"<article class=post>Text<section class=comments><article class=comment>{LONG_TEXT}</article></section></article>", "Text"),
    # Text around an article stays; quotes inside unquoted values and open quotes swallow nothing.
    ("<p>lead</p><article>in</article><p>after</p>", "lead\nin\nafter"),
    ("<p>one</p><p title=it's>two</p><p>three isn't</p>", "one\ntwo\nthree isn't"),
    ("<p title='a>b' class=x>one</p><p data-x=\"1>2\">two", "one\ntwo"),
    (f"<div class=ad>Buy <div>{LONG_TEXT * 20}</div>", "Buy\n" + (LONG_TEXT * 20).strip()),  # not closed, and far too long for an advert
])
def test_html_keeps_text_whole(page, expected):
    assert main_text(page) == expected


def test_surge_and_dive_part_text_from_the_rest_without_names():
    """No telling tag, class or id: menus, a row of links, a teaser and a footer line go by the sums alone."""
    menu = "<div><ul>" + "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(30)) + "</ul></div>"
    row = '<div><div><a href="/a">Home page of us</a> | <a href="/b">All the news of today</a></div></div>'
    text = f"<div><h1>Title</h1><p>{LONG_TEXT}</p><p>Yes.</p><ul><li>a</li><li>b</li></ul><table><tr><td>1<td>2</table></div>"
    page = f"<body>{row}{menu}<div><div>Weather: fine</div></div>{text}{menu}<div><div>(c) 2020 Example, all rights</div></div>{row}"
    expected = f"Title\n{LONG_TEXT.strip()}\nYes.\na\nb\n1\n2"
    assert main_text(page) == expected
    assert main_text(page.replace(LONG_TEXT, LONG_TEXT * 200)) == expected.replace(LONG_TEXT.strip(), (LONG_TEXT * 200).strip())
    assert main_text(f"{menu}<p>{LONG_TEXT}</p>") == LONG_TEXT.strip()  # the edge of one stretch


class Tree(HTMLParser):
    """A second reading of well-formed pages: a stack of open elements, lines with the stack they stand in."""

    def __init__(self):
        super().__init__()
        self.stack, self.lines, self.text = [], [], ""

    def end(self, empty=0):
        text = " ".join(self.text.split())
        names = [n for n, _ in self.stack]
        if text and not {"nav", "footer", "head", "script", "style", "title"} & set(names):
            self.lines.append((text, "article" in names, next((i for i, c in self.stack if c), 0)))
        self.lines += [("", False, 0)] * empty
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        elif tag not in ("b", "a", "meta"):
            self.end(tag not in ("p", "h1", "li", "ul"))
            named = (len(self.lines) + 1) if dict(attrs).get("class") == "ad" else 0
            self.stack += [] if tag in ("p", "h1", "li", "ul", "html", "body") else [(tag, named) if not named else (named, named)]

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.end(tag not in ("p", "h1", "li", "ul"))
            if self.stack and tag not in ("p", "h1", "li", "ul", "html", "body"):
                self.stack.pop()

    def handle_data(self, data):
        self.text += data


def brute_main_text(page):
    tree = Tree()
    tree.feed(page)
    tree.close()
    tree.end()
    rows = tree.lines
    has_article = any(content for _, content, _ in rows)
    own = [100 + len(t) if content else len(t) * (0.25 if has_article else 1) * (0.02 if named else 1) for t, content, named in rows]
    kept = []
    for flow in {named for *_, named in rows}:
        at = [k for k, r in enumerate(rows) if r[2] == flow]
        sums = [own[k] + (own[at[i + 1]] if i + 1 < len(at) else 0) for i, k in enumerate(at)]
        top = max([own[a] + own[b] for a, b in zip(at, at[1:])] + [own[k] for k in at])
        for i, k in enumerate(at):  # the stretch of a line: as far as no sum is zero
            a = next(j + 1 for j in range(i, -2, -1) if j < 0 or not sums[j])
            b = next(j for j in range(i, len(at) + 1) if j == len(at) or not sums[j])
            if rows[k][0] and max(sums[a:b]) >= (100 if flow else min(100, 0.3 * top)):
                kept.append(k)
    return "\n".join(rows[k][0] for k in sorted(kept))


def test_html_rows(spark):
    """All given pages, and the same with less to tell text from the rest by."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<nav>|<article>|<footer>", "<div>"), "</(nav|article|footer)>", "</div>"))
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], pages.schema)
    both = pages.union(odd).withColumn("text", F.lit("x"))
    got = as_rows(extract_text(both))
    assert got == Counter((r.page_id, r.url, t := brute_main_text(r.html or ""), len(t)) for r in both.collect())
    unnamed = plain.withColumn("html", F.regexp_replace("html", "<a [^>]*>", "<a>"))
    texts = {r.page_id: r.text for r in extract_text(unnamed).collect()}
    given = {r.page_id: r.text for r in extract_text(pages).collect()}
    same = sum(given[k] in texts[k] for k in given)
    assert same == len(given)  # no text is lost without the tags that name it


def brute_hits(docs, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = []
    for i, t in items:
        w = split(t)
        m = min(10, len(w))
        windows += [(i, tuple(w[k : k + m])) for k in range(len(w) - m + 1) if m]
    by = {}
    for i, w in windows:
        by.setdefault(w, set()).add(i)
    widths = {len(w) for w in by}
    result = Counter()
    for i, t in docs:
        w = split(t)
        hit, found = set(), set()
        for m in widths:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k : k + m])) in by:
                    hit.update(range(k, k + m))
                    found |= by[x]
        names = sorted(str(x) for x in found if x is not None)
        sha = hashlib.sha256(",".join(names).encode()).hexdigest()
        result[i, len(w), len(hit), len(names), sha, bool(hit)] += 1
    return result


@pytest.mark.parametrize("block_bytes", [1 << 22, 2000])
def test_decontamination(spark, both, block_bytes):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    more = [(900, "one"), (901, "a b c d e f"), (902, None), (903, " .. "), (904, "ONE one two"), (None, "two a b")]
    more += [(905, LONG[:300]), (906, LONG[:300])]
    items = benchmark.union(spark.createDataFrame(more, "item_id long, text string"))
    expected = brute_hits(texts(both), [(r.item_id, r.text) for r in items.collect()])
    rows = both.select("doc_id", "text")
    found = contamination(rows, items, block_bytes=block_bytes).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids"), F.sha2(F.array_join("item_ids", ","), 256), F.col("n_hit") > 0
    )
    assert as_rows(found) == expected


def test_places_of_hits(spark, both):
    """``hit_spans`` lists the runs of consecutive hit words: touching and overlapping matches are one."""
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    more = [(900, "one"), (901, "a b c d e f"), (902, None), (905, LONG[:300]), (906, LONG[200:500])]
    items = items.union(spark.createDataFrame(more, "item_id long, text string"))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in items.collect():
        w = split(r.text)
        windows |= {tuple(w[k : k + min(10, len(w))]) for k in range(max(1, len(w) - 9)) if w}
    expected = Counter()
    for i, t in texts(both):
        w, hit = split(t), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit.update(range(k, k + m))
        starts = sorted(p for p in hit if p - 1 not in hit)
        ends = sorted(p + 1 for p in hit if p + 1 not in hit)
        expected[i, ",".join(f"{a}:{b - a}" for a, b in zip(starts, ends))] += 1
    assert as_rows(contaminated_documents(both, items).select("doc_id", "hit_spans")) == expected
    assert any("," in places for _, places in expected)


def test_kept_columns_named_like_results(spark):
    docs = spark.createDataFrame([(1, "a", 2, [3])], "doc_id long, text string, shard long, ids array<int>")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for call in (
        lambda: bpe_encode(docs, ("doc_id", "ids")), lambda: bpe_decode(docs, ("doc_id", "text")),
        lambda: encode_in_order(docs, metadata=["shard"]),
        lambda: contamination(docs.withColumnRenamed("ids", "spans"), items, ("doc_id", "spans")),
    ):
        with pytest.raises(ValueError, match="rename"):
            call()


def test_longest_matches_have_places(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, f"x y {item} z"), (2, "nothing " * 20)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(2, 30, "7", 0)] and rows[1].n_hit == 30 and not rows[2].spans
    assert [r.doc_id for r in remove_contaminated(docs, items).collect()] == [2]


def test_decontamination_without_items(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated_documents(odd, none).filter("contaminated").count() == 0
    assert remove_contaminated(odd, none).columns == odd.columns


@pytest.mark.parametrize("count", [1, 3, 8])
def test_shards(both, count):
    rows = shards(both, count).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == both.count() and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == count
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows") for i, t in texts(both))
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law) for r in rows) == expected
    source = {r.doc_id: r.source for r in both.collect() if r.doc_id is not None and r.doc_id > 20}
    for name in set(source.values()):
        per = Counter(r.shard for r in rows if source.get(r.doc_id) == name)
        of = sum(per.values())
        assert all(abs(per[s] - of / count) <= 2.5 for s in sizes)


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    items = spark.createDataFrame([(1, "x")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    results = [
        bpe_digests(none), token_files(none), quality_scores(none, labels), quality_rules(none),
        near_duplicate_rows(none), pii_spans(none), extract_text(pages), contaminated_documents(none, items), shards(none),
        token_counts(none), keep_good(none), one_of_each_group(none), sanitised(none), remove_contaminated(none, items),
    ]
    assert [df.count() for df in results] == [0] * len(results)
