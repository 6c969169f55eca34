"""The corpus pipeline: planted rows, and every stage against a brute-force version on the smallest tables."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meldspark.llm.op04_quality import quality_rules
from meldspark.llm.op06_pii import pii_spans
from meldspark.llm.tokenizer_files import load_tokenizer
from meldspark.session import staged_tables
from test_operators import base_spans, brute_hits, fingerprint, linked

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after every stage."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        function(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        found.append(docs)
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "bpe"]


def test_quality_stage(stages):
    verdicts = by_id(quality_rules(stages[0]))
    assert by_id(stages[1]).keys() == {i for i, r in verdicts.items() if r.kept}


def test_near_dedup_stage(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    ids = list(before)
    groups = linked([fingerprint(before[i].text) for i in ids], ids)
    assert after.keys() == set(groups) and all(after[i] == before[i] for i in after)


def test_decontamination_stage(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = by_id(stages[2]), by_id(stages[3])
    hit = {row[0] for row in brute_hits([(i, r.text) for i, r in before.items()], items) if row[-1]}
    assert hit and after.keys() == before.keys() - hit


def test_pii_stage(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    spans = by_id(pii_spans(stages[3]))
    assert before.keys() == after.keys()
    changed = {i for i in before if before[i].text != after[i].text}
    assert changed == {i for i, r in spans.items() if r.spans}
    for i, row in after.items():
        assert row.n_chars == len(row.text) or i not in changed
        assert not any(base_spans(row.text)[kind] for kind in ("email", "ip", "card"))
        assert not changed or re.search(r"\[(EMAIL|IP|CARD|PHONE|TERM)\]", row.text) or i not in changed


def test_bpe_stage(stages):
    library = load_tokenizer("byte_bpe_50k.json")
    texts = by_id(stages[4])
    for r in stages[5].collect():
        assert r.ids == library.encode(texts[r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
    assert stages[5].count() == len(texts)


def test_run_applies_all_stages(spark, stages):
    key = F.xxhash64("doc_id", "ids")
    before = len(staged_tables())
    result = corpus_pipeline.run(spark, SF_DIR)
    assert len(staged_tables()) == before + 1  # the result; what the stages left is removed
    whole = result.agg(F.count(F.lit(1)), F.sum(key.cast("decimal(38,0)"))).first()
    assert whole == stages[-1].agg(F.count(F.lit(1)), F.sum(key.cast("decimal(38,0)"))).first()


def test_extra_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = {name: F.lit("x") for name in ("row", "uid", "fp", "kept", "component_id", "n_words", "spans", "item_ids", "_t")}
    docs = docs.withColumns(extra)
    for name, function in corpus_pipeline.STAGES[:-1]:
        result = function(spark, docs, SF_DIR)
        assert result.columns == docs.columns, name
        assert result.filter("fp <> 'x' OR row <> 'x'").count() == 0


def test_clean_documents_stay(spark):
    """What labels call good and no benchmark passage touches passes the quality stage."""
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    verdicts = quality_rules(docs).join(labels, "doc_id")
    good = verdicts.filter("quality = 1 AND NOT base_failed")
    assert good.filter("NOT kept").count() <= 0.01 * good.count()
    bad = verdicts.filter("quality = 0")
    assert bad.filter("kept").count() <= 0.2 * bad.count()
