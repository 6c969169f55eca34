"""Readers: positions over files and splits, quoting, YAML forms, manifests."""

import pytest
from pyspark.sql import functions as F

from meldspark.session import broadcast_if_small, new_shared_path, shared_dir, stage
from meldspark.sinks.files import write_delimited, write_yaml_stream
from meldspark.sources.files import read_delimited, read_json_lines
from meldspark.sources.numbering import number_in_order
from meldspark.sources.tables import read_json_document
from meldspark.sources.yaml_stream import read_yaml_stream

YAML_SCHEMA = "member_id string, contact struct<email: string>, value string"


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that small files fall into many tasks."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_positions_over_files_of_different_size(spark, tmp_path, small_splits):
    expected, position = [], 0
    for number, size in enumerate((300, 3, 120, 0, 40)):
        lines = [f"{number}-{i};v{i}" for i in range(size)]
        (tmp_path / f"part-{number}.csv").write_text("key;value\n" + "".join(line + "\n" for line in lines))
        for line in lines:
            position += 1
            expected.append((line.split(";")[0], position))
    df = read_delimited(spark, str(tmp_path), ["key", "value"], numbered=True)
    assert sorted((r.key, r.source_row) for r in df.collect()) == sorted(expected)


def test_quotes_and_blank_fields(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('a;b\n"x;""y""\\";\n"";" pad "\n')
    assert [tuple(r) for r in read_delimited(spark, str(path), ["a", "b"]).collect()] == [('x;"y"\\', None), (None, " pad ")]


def test_ragged_line_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a;b\n1;2;3\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(path), ["a", "b"]).collect()


def test_padding_survives_writing(spark):
    path = new_shared_path(spark, "padding")
    write_delimited(spark.createDataFrame([("  x ", "y")], "a string, b string"), path, sep=";", header=True)
    assert tuple(read_delimited(spark, path, ["a", "b"]).first()) == ("  x ", "y")


def test_json_scalars_become_text(spark, tmp_path):
    path = tmp_path / "j.jsonl"
    path.write_text('{"id": 5, "active": true, "ltv": 12.5, "address": {"zip": 7}}\n{"id": "6", "ltv": "N/A"}\n')
    rows = read_json_lines(
        spark, str(path), "id string, active string, ltv string, address struct<zip: string>", numbered=True
    ).orderBy("source_row").collect()
    assert [(r.source_row, r.id, r.active, r.ltv, r.address and r.address.zip) for r in rows] == [
        (1, "5", "true", "12.5", "7"), (2, "6", None, "N/A", None)
    ]


def test_malformed_json_fails(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"id": 5}\n{"id": \n')
    with pytest.raises(Exception):
        read_json_lines(spark, str(path), "id string").collect()


FORMS = {
    "stream": "# head\n---\n- member_id: 1\n  contact:\n    email: a@b.c\n- member_id: 2\n---\n- member_id: 3\n  value: 1.50\n",
    "no head": "- member_id: 1\n  contact: {email: a@b.c}\n- member_id: 2\n  contact:\n- member_id: 3\n  value: '1.50'\n",
    "carriage returns": "---\r\n- member_id: 1\r\n  contact:\r\n    email: a@b.c\r\n- member_id: 2\r\n---\r\n- member_id: 3\r\n  value: \"1.50\"\r\n",
    "commented markers": "--- # one\n- member_id: 1\n  contact:\n    email: a@b.c\n...\n--- # two\n- member_id: 2\n# note\n- member_id: 3\n  value: '1.50'\n---\n---\n",
    "indented": "---\n  - member_id: 1\n    contact:\n      email: a@b.c\n  - member_id: 2\n---\n  - member_id: 3\n    value: '1.50'\n",
}


@pytest.mark.parametrize("form", FORMS)
def test_yaml_forms(spark, tmp_path, form):
    path = tmp_path / "m.yml"
    path.write_bytes(FORMS[form].encode())
    rows = read_yaml_stream(spark, str(path), YAML_SCHEMA, numbered=True).orderBy("source_row").collect()
    found = [(r.source_row, r.member_id, r.contact and r.contact.email, r.value) for r in rows]
    value = "1.5" if form == "stream" else "1.50"
    assert found == [(1, "1", "a@b.c", None), (2, "2", None, None), (3, "3", None, value)]


def test_yaml_entries_across_splits_and_files(spark, tmp_path, small_splits):
    expected = []
    for number in range(3):
        text = "# head\n"
        for i in range(80):
            text += ("---\n" if i % 7 == 0 else "") + f'- member_id: {number + 1}{i:02d}\n  contact:\n    email: "x{i}"\n'
            expected.append(f"{number + 1}{i:02d}")
        (tmp_path / f"f{number}.yml").write_text(text)
    df = read_yaml_stream(spark, str(tmp_path), YAML_SCHEMA, numbered=True)
    assert [r.member_id for r in df.orderBy("source_row").collect()] == expected
    assert [r.source_row for r in df.orderBy("source_row").collect()] == list(range(1, 241))


ENTRIES = [
    '- a: "x"', '- a: 1\n  b: "ü ; # {"', "- a:\n  b: 2", '- a:\n    c: "q"\n    d: 7\n  b: null', "- a: 010\n  b: 1_0",
    '- a: "e\\n\\u00e9"', "- a: plain text\n  b: 'single'", "- a: yes\n  yes: 1", "- a: 1\n  a: 2", "- a: [1, 2]\n  b: {c: 3}",
    '- a: "two\n    lines"', "- a: |\n    block\n    text\n  b: 1", "- a: 1 # note", "- a: 1.50\n  b: 1e3", "- a: 2020-01-02",
    "- a: true\n  b: false\n  c: null", '- {"a": 1, "b": "c"}', "- a:\n      deep:\n        deeper: 1", '- a: "x" ', "- a : 1",
    '- a: "\u2028"', "- a: ~", "- a: 0\n\n  b: 1", "- a: -5", '- a: ""', "- a: 1\n# note", "- a: 1\n...",
]


@pytest.mark.parametrize("indent", ["", "  "])
@pytest.mark.parametrize("per_document", [1, 3, 100])
def test_yaml_entries_agree_with_the_loader(spark, per_document, indent):
    """Each kind of entry, plain or not, between plain ones; in batches of different sizes."""
    import json

    import pandas as pd
    import yaml

    from meldspark.sources.yaml_stream import _entry_parser, plain_json

    entries = [e for entry in ENTRIES for e in ('- a: "p"\n  b:\n    c: 3', entry)]
    entries = [e if e.endswith("...") else e.replace("\n", f"\n{indent}") for e in entries]
    stream = "# head\n"
    for i, entry in enumerate(entries):
        opens = i % per_document == 0 or entries[i - 1].endswith("...")
        stream += ("---\n" if opens else "") + indent + entry + "\n"
    expected = [json.loads(json.dumps(e, default=str)) for d in yaml.safe_load_all(stream) for e in d or ()]
    rows = list(enumerate(stream.split(f"\n{indent}- ")))
    chunks = spark.createDataFrame(rows, "n int, value string").withColumn("_json", plain_json(F.col("value"), indent))
    chunks = pd.DataFrame([r.asDict() for r in chunks.orderBy("n").collect()]).assign(_file="f", _split=0)
    assert 20 < chunks["_json"].notna().sum() < len(chunks) - 10
    batches = [chunks[:1], chunks[1:8], chunks[8:]]
    found = [json.loads(e) for out in _entry_parser(indent)(batches) for e in out["entry"]]
    assert found == expected


def test_indented_stream_falls_into_splits(spark, tmp_path, small_splits):
    from meldspark.sources.yaml_stream import entry_chunks, files_by_indent

    text = "---\n" + "".join(f'  - member_id: {i}\n    contact:\n      email: "x{i}"\n' for i in range(200))
    (tmp_path / "m.yml").write_text(text)
    ((indent, paths),) = files_by_indent(spark, str(tmp_path))
    chunks = entry_chunks(spark, paths, indent)
    filled = chunks.groupBy(F.spark_partition_id()).count().count()
    assert indent == "  " and filled > 8 and filled >= chunks.select("_split").distinct().count() - 1
    rows = read_yaml_stream(spark, str(tmp_path), YAML_SCHEMA, numbered=True).collect()
    assert sorted((r.source_row, r.member_id, r.contact.email) for r in rows) == [
        (i + 1, str(i), f"x{i}") for i in range(200)
    ]


def test_columns_are_found_by_header(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("b;a;c\n1;2;3\n")
    assert tuple(read_delimited(spark, str(path), ["a", "b"]).first()) == ("2", "1")
    assert read_delimited(spark, str(path), ["a"], numbered=True).first().source_row == 1
    with pytest.raises(ValueError, match="no column d"):
        read_delimited(spark, str(path), ["a", "d"])


def test_files_are_read_by_their_own_headers(spark, tmp_path, small_splits):
    """Three column orders in one folder, several splits each; names with blanks and pattern signs; an empty file."""
    expected = []
    for number, (name, header) in enumerate([("p 1.csv", "a;b"), ("p[2].csv", "b;x;a"), ("p%203.csv", "a;b"), ("p4.csv", "x;b;a")]):
        rows = [{"a": f"a{number}-{i}", "b": f"b{number}-{i}", "x": "x"} for i in range(100)]
        lines = [";".join(row[c] for c in header.split(";")) for row in rows]
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
        expected += [(name, row["a"], row["b"]) for row in rows]
    (tmp_path / "p5.csv").write_text("")
    got = read_delimited(spark, str(tmp_path), ["a", "b"], numbered=True)
    numbers = {(r.a, r.b): r.source_row for r in got.collect()}
    assert len(numbers) == 400 and sorted(numbers.values()) == list(range(1, 401))
    for start in range(0, 400, 100):  # rows of a file stay together and in order
        own = [numbers[expected[k][1:]] for k in range(start, start + 100)]
        assert own == list(range(own[0], own[0] + 100))


def test_a_file_without_a_column_fails(spark, tmp_path):
    (tmp_path / "p1.csv").write_text("a;b\n1;2\n")
    (tmp_path / "p2.csv").write_text("b;c\n1;2\n")
    with pytest.raises(ValueError, match="no column a"):
        read_delimited(spark, str(tmp_path), ["a", "b"])


@pytest.mark.parametrize("in_driver", [True, False])
def test_heads_of_files(spark, tmp_path, small_splits, monkeypatch, in_driver):
    import gzip

    from meldspark.sources import heads

    monkeypatch.setattr(heads, "DRIVER_FILES", 512 if in_driver else 0)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    for name, head in (("x 1.txt", "one"), ("y[2].txt", "two"), ("z.txt", "one"), ("zz.txt.gz", "\u00e9")):
        text = "# note\n" * 300 + f"is {head} \n" + "is other\n" * 2000
        (tmp_path / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())
    (tmp_path / "zzz.txt").write_text("")
    groups = heads.files_by_head(spark, str(tmp_path), r"^is (\S+)")
    assert [(head, len(files)) for head, files in groups] == [("one", 2), ("two", 1), ("\u00e9", 1)]
    assert [spark.read.text(files).count() for _, files in groups] == [4602, 2301, 2301]
    assert heads.files_by_head(spark, str(tmp_path), "^(nowhere)") == []
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_yaml_files_are_cut_at_their_own_indents(spark, tmp_path, small_splits):
    from meldspark.sources.yaml_stream import entry_chunks, files_by_indent

    expected = []
    for number, indent in enumerate(("", "  ", "", "    ")):
        entry = f'{indent}- member_id: {{}}\n{indent}  contact:\n{indent}    email: "x{{}}"\n'
        ids = range(1000 * number, 1000 * number + 150)
        (tmp_path / f"m{number}.yml").write_text("# head\n---\n" + "".join(entry.format(i, i) for i in ids))
        expected += [(str(i), f"x{i}") for i in ids]
    (tmp_path / "m9.yml").write_text("# nothing\n")
    groups = files_by_indent(spark, str(tmp_path))
    assert [(indent, len(files)) for indent, files in groups] == [("", 2), ("  ", 1), ("    ", 1)]
    for indent, files in groups:  # each file falls into several tasks
        assert entry_chunks(spark, files, indent).select(F.spark_partition_id()).distinct().count() > 4
    rows = read_yaml_stream(spark, str(tmp_path), YAML_SCHEMA, numbered=True).collect()
    assert [(r.member_id, r.contact.email) for r in sorted(rows, key=lambda r: r.source_row)] == expected


def test_numbering_shuffles_no_data_rows(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a;b\n" + "1;2\n" * 50)
    df = read_delimited(spark, str(tmp_path), ["a", "b"], numbered=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_staged_tables_can_be_removed(spark):
    import os

    from meldspark.session import remove_staged, staged_tables

    before = len(staged_tables())
    stage(spark.range(3), "gone")
    path = staged_tables()[-1].removeprefix("file:")
    assert os.path.isdir(path) and remove_staged(spark, before) == 1
    assert not os.path.exists(path) and len(staged_tables()) == before


def test_yaml_documents_have_the_given_length(spark):
    path = new_shared_path(spark, "yaml-length")
    entries = spark.range(25).select("id", F.concat(F.lit("- member_id: "), F.col("id").cast("string")).alias("entry"))
    write_yaml_stream(entries, path, "entry", ["id"], per_document=10, title="T")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines.count("---") == 3 and lines.count("# T") == 1 and len(lines) == 29
    assert read_yaml_stream(spark, path, YAML_SCHEMA).count() == 25


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_numbers_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(partitions)
    rows = number_in_order(df, [F.desc("k")]).collect()
    assert all(r.id == 1000 - r.k for r in rows) and len(rows) == 1000


def test_manifest_may_be_missing(spark, tmp_path):
    assert read_json_document(spark, str(tmp_path / "manifest.json")) is None
    (tmp_path / "manifest.json").write_text('{\n "seed": 7,\n "sources": {"crm": {"records": 5}}\n}')
    document = read_json_document(spark, str(tmp_path / "manifest.json"), "seed int, sources map<string, struct<records: long>>")
    assert document.select("seed", "sources.crm.records").first() == (7, 5)


def test_broadcast_only_after_counting(spark):
    plan = lambda df: df._jdf.queryExecution().toString()
    big, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(10)
    assert "broadcast" in plan(big.join(broadcast_if_small(small), big.k == small.id)).lower()
    assert "UnresolvedHint" not in plan(broadcast_if_small(big, max_rows=10)) and "ResolvedHint" not in plan(broadcast_if_small(big, max_rows=10))


def test_stage_cuts_lineage(spark):
    staged = stage(spark.range(5).withColumn("x", F.rand()), "test")
    assert staged.count() == 5 and "Range" not in staged._jdf.queryExecution().toString()
    assert staged.inputFiles()[0].startswith(("file:", shared_dir(spark)))


def test_package_reaches_workers(tmp_path):
    """In a process whose workers know the package only because it was sent to them."""
    import os
    import subprocess
    import sys

    import meldspark

    root = os.path.dirname(os.path.dirname(os.path.abspath(meldspark.__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from meldspark.session import build_session, ship_package
spark = build_session("ship", "local[1]", spark__ui__enabled="false")
ship_package(spark)
where = F.udf(lambda x: __import__("meldspark.session").__file__)
print("found in", spark.range(1).select(where("id")).first()[0])
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    found = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "found in" in found.stdout and "meldspark.zip" in found.stdout, found.stderr[-2000:]


def test_yaml_entries_are_made_once(spark, tmp_path):
    """A sort reads its input twice; making the entries is the dear part and happens before."""
    from meldspark.plans.exports import write_legacy

    made = spark.sparkContext.accumulator(0)

    def name(number):
        made.add(1)
        return f"N{number}"

    texts = "'x' last_name, 'e' email, 'p' phone, 's' street, 'c' city, 'z' postal_code, 'X' native_name"
    rows = spark.range(500).selectExpr(
        "id record_id", "id customer_id", "0 copy", *texts.split(", "), "DATE'2000-01-02' birth_date", "true is_active",
        "TIMESTAMP_NTZ'2020-01-02 03:04:05' registered_at", "id lifetime_cents",
        *[f"CAST(NULL AS STRING) {c}" for c in ("birth_text", "country_text", "value_text")],
    ).withColumn("first_name", F.udf(name, "string")("record_id"))
    write_legacy(rows, f"{tmp_path}/stream", per_document=7)
    read = read_yaml_stream(spark, f"{tmp_path}/stream", "member_id string, name string", numbered=True)
    assert {(r.source_row, r.member_id, r.name) for r in read.collect()} == {(k + 1, str(k), f"x, N{k}") for k in range(500)}
    assert made.value == 500
