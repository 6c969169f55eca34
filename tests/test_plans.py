"""Physical plans of the operators that matter at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from meldspark.operators import integrity
from meldspark.operators.integrity import orphans
from meldspark.operators.merge import keep_first, merge_by_trust

SF_DIR = "/root/testdata/sf0.001"


def explained(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


def test_lookup_filter_reaches_the_scan(spark):
    plan = explained(spark_entry.queries()["point_lookup"](spark, SF_DIR))
    assert "EqualTo(c_custkey,7)" in plan


def test_report_reads_only_its_columns(spark):
    plan = explained(spark_entry.queries()["income_bracket_report"](spark, SF_DIR))
    assert "o_totalprice" not in plan and "c_name" not in plan and "IsNotNull(o_custkey)" in plan


def test_merge_is_one_shuffle_after_a_partial_aggregate(orders):
    merged = merge_by_trust(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"], "o_orderstatus", "states"
    )
    plan = explained(merged)
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("ObjectHashAggregate") == 2 and "Window" not in tree


def test_keep_first_limits_groups_before_the_shuffle(orders):
    tree = explained(keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2


def test_references_are_counted_before_the_join(spark, orders):
    parents = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    tree = explained(orphans(orders, "o_custkey", parents, "c_custkey")).split("\n\n")[0]
    assert tree.index("Join") < tree.index("HashAggregate")


def test_word_count_stays_in_the_jvm(spark):
    plan = explained(spark_entry.queries()["word_count"](spark, SF_DIR))
    assert "Python" not in plan and "InPandas" not in plan


def test_ties_spread_over_ranges(spark):
    from meldspark.sources.numbering import number_in_order

    df = spark.range(5000).select("id", F.lit("same").alias("k")).repartition(5)
    first = {r.id: r.n for r in number_in_order(df, ["k"], "n").collect()}
    again = {r.id: r.n for r in number_in_order(df.repartition(3), ["k"], "n").collect()}
    assert first == again and sorted(first.values()) == list(range(1, 5001))


def test_only_repeated_slots_are_joined(spark):
    from meldspark.operators.generate import country_pools, overlap_pool, synthetic_customers, with_overlap
    from meldspark.session import stage
    from meldspark.sources.countries import country_dictionary

    pools = country_pools(spark, country_dictionary(spark))
    first, second = (synthetic_customers(spark.range(a, a + 400), "id", pools, 3) for a in (0, 1000))
    records = with_overlap(second, stage(overlap_pool(first, 20, 3), "pool"), 0.25, 3)
    plan = explained(records)
    assert "LeftOuter" not in plan and "Union" in plan
    assert records.count() == 400 and 60 < records.filter("repeated").count() < 140


def test_listing_breaks_ties(spark):
    from meldspark.plans.analytics import wealth_listing

    df = spark.range(200).select("id", F.lit(1.0).alias("per_head"))
    assert [r.id for r in wealth_listing(df).collect()] == [r.id for r in wealth_listing(df.repartition(7)).collect()]


@pytest.fixture
def no_coalescing(spark):
    """Ranges as the cluster would have them: small ones are not put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_rows_spread_over_ranges(spark, no_coalescing):
    from meldspark.session import staged_tables
    from meldspark.sources.numbering import number_in_order

    df = spark.range(5000).select(F.lit("same").alias("k")).repartition(5)
    before = len(staged_tables())
    assert sorted(r.n for r in number_in_order(df, ["k"], "n").collect()) == list(range(1, 5001))
    parts = spark.read.parquet(staged_tables()[before]).groupBy("_split").count().collect()
    assert len(parts) > 3 and max(r["count"] for r in parts) < 2500


def test_numbers_come_from_totals_taken_while_writing(spark, no_coalescing):
    """One table is staged and only the rows themselves are read from it; no table of splits, no second scan."""
    from meldspark.session import staged_tables
    from meldspark.sources.numbering import number_in_order

    before = len(staged_tables())
    numbered = number_in_order(spark.range(3000).repartition(7), [F.desc("id")], "n")
    tree = explained(numbered).split("\n\n")[0]
    assert len(staged_tables()) == before + 1 and tree.count("Scan parquet") == 1 and "hashpartitioning" not in tree
    assert all(r.n == 3000 - r.id for r in numbered.collect())
    assert number_in_order(spark.range(0), ["id"], "n").count() == 0


def test_yaml_stream_takes_one_range_shuffle(spark, no_coalescing, monkeypatch):
    """Document borders over several files come from the totals, and the files in order are the stream."""
    import os

    from meldspark.session import new_shared_path, remove_staged, staged_tables
    from meldspark.sinks.files import write_yaml_stream
    from meldspark.sources import numbering
    from meldspark.sources.yaml_stream import read_yaml_stream

    plans = []
    real = numbering.with_range_places
    import meldspark.sinks.files as files

    monkeypatch.setattr(files, "with_range_places", lambda *a: plans.append(real(*a)) or plans[-1])
    ids = spark.range(1000).repartition(6)
    entries = ids.select("id", F.concat(F.lit("- id: "), F.col("id").cast("string")).alias("entry"))
    before = len(staged_tables())
    path = new_shared_path(spark, "yaml-ranges-test")
    write_yaml_stream(entries, path, "entry", ["id"], per_document=64, title="T")
    assert explained(plans[0]).split("\n\n")[0].count("Exchange") == 2  # the input's own and one for the order
    folder = path.removeprefix("file:")
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    text = "".join(open(os.path.join(folder, p)).read() for p in parts)
    expected = "# T\n" + "".join(f"---\n- id: {i}\n" if i % 64 == 0 else f"- id: {i}\n" for i in range(1000))
    assert len(parts) > 3 and text == expected
    rows = read_yaml_stream(spark, path, "id long", numbered=True).collect()
    assert sorted((r.source_row, r.id) for r in rows) == [(i + 1, i) for i in range(1000)]
    assert remove_staged(spark, before) > 0 and len(staged_tables()) == before


def test_duplicate_keys_of_a_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(integrity, "ROWS_PER_TASK", 1000, raising=False)
    rows = spark.range(20_000).union(spark.range(20_000)).union(spark.range(1).crossJoin(spark.range(5_000).select()))
    rows = rows.union(spark.createDataFrame([(None,), (None,), (77_777,)], "id long"))
    found = integrity.duplicate_keys(rows, ["id"])
    assert {r.rows for r in found.filter("id > 0").collect()} == {2} and found.filter("id = 0").first().rows == 5_002
    assert found.count() == 20_000
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert max(sizes) <= 1000
