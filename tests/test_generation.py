"""Generated sources: equal for equal seeds, and consolidation invariants over several seeds."""

import pytest
from pyspark.sql import functions as F

from meldspark.functions.draws import draw
from meldspark.operators.generate import DEFECTS, country_pools, synthetic_customers
from meldspark.operators.sampling import fixed_sample
from meldspark.plans.customers import (
    CRM_FILE,
    LEGACY_FILE,
    MANIFEST_FILE, MANIFEST_SCHEMA,
    WEBSHOP_FILE,
    consolidate_files,
    rejection_rules,
)
from meldspark.plans.exports import generate_sources
from meldspark.session import new_shared_path
from meldspark.sources.countries import COUNTRIES, country_dictionary
from meldspark.sources.tables import read_json_document


def generate(spark, seed, partitions=None):
    folder = new_shared_path(spark, "generated")
    keys = {
        name: spark.range(start, start + 300, numPartitions=partitions or 4)
        for name, start in (("crm", 0), ("webshop", 1000), ("legacy", 2000))
    }
    generate_sources(spark, keys, folder, seed, 0.2, 0.2, per_document=50, pool_size=40)
    return folder


def content(spark, folder):
    lines = {}
    for name in (CRM_FILE, WEBSHOP_FILE, LEGACY_FILE, MANIFEST_FILE):
        lines[name] = [r.value for r in spark.read.text(f"{folder}/{name}").collect()]
    lines[CRM_FILE] = [line for line in lines[CRM_FILE] if not line.startswith("customer_id;")]
    return {name: sorted(values) for name, values in lines.items()}


def test_same_seed_gives_the_same_files_on_any_partitioning(spark):
    first, second, other = generate(spark, 7), generate(spark, 7, 11), generate(spark, 8)
    assert content(spark, first) == content(spark, second)
    assert content(spark, first) != content(spark, other)


@pytest.mark.parametrize("seed", [7, 42])
def test_consolidation_invariants(spark, seed):
    folder = generate(spark, seed)
    result = consolidate_files(spark, folder)
    manifest = read_json_document(spark, f"{folder}/{MANIFEST_FILE}", MANIFEST_SCHEMA).first()
    summary = {(r.metric, r.item): r.rows for r in result.summary.collect()}
    read = {item: rows for (metric, item), rows in summary.items() if metric == "rows_read"}
    assert read == {name: report.records for name, report in manifest.sources.items()}
    assert manifest.sources["crm"].customers_also_in_earlier_sources == 0
    assert manifest.sources["legacy"].customers_also_in_earlier_sources > 0
    assert {d for report in manifest.sources.values() for d in report.defects} <= set(DEFECTS)

    customers = result.customer
    loaded = customers.count()
    assert customers.select("customer_id").distinct().count() == loaded == summary["customers_loaded", ""]
    assert 0 < loaded <= manifest.unique_customers
    assert {r[0] for r in customers.select("country_code").distinct().collect()} <= {c.code for c in COUNTRIES}
    assert customers.filter(F.col("sources").like("%,%")).count() > 0
    first = F.left("first_name", F.lit(1))
    assert customers.filter((F.col("first_name") != F.trim("first_name")) | (first != F.upper(first))).count() == 0

    found = {r.reason for r in result.rejected_row.select("reason").distinct().collect()}
    assert found and found <= {name for name, _ in rejection_rules()}
    assert "unknown country" not in found
    rejected = sum(rows for (metric, _), rows in summary.items() if metric == "rejected")
    assert summary["valid_rows", ""] == sum(read.values()) - rejected
    assert summary["merged_duplicates", ""] == summary["valid_rows", ""] - loaded


def test_fixed_sample_is_exact_and_uniform(spark):
    df = spark.range(20_000)
    sample = fixed_sample(df, "id", 2000, 3)
    ids = {r.id for r in sample.collect()}
    assert len(ids) == 2000
    assert ids == {r.id for r in fixed_sample(df.repartition(13), "id", 2000, 3).collect()}
    assert 850 < sum(i < 10_000 for i in ids) < 1150
    assert fixed_sample(spark.range(5), "id", 10, 3).count() == 5


@pytest.mark.parametrize("rows", [20, 5000])
def test_rows_without_a_key_are_never_sampled(spark, rows):
    df = spark.range(rows).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    sample = fixed_sample(df, "k", 8, 3).collect()
    assert len(sample) == 8 and all(r.k is not None for r in sample)


def test_drawn_values_stay_in_their_ranges(spark):
    pools = country_pools(spark, country_dictionary(spark))
    df = synthetic_customers(spark.range(3000), "id", pools, 1)
    row = df.agg(
        F.min("birth_date"), F.max("birth_date"), F.min("registered_at"), F.max("registered_at"),
        F.min("lifetime_cents"), F.max("lifetime_cents"), F.avg(F.col("is_active").cast("int")),
        F.count_distinct("country_code"), F.count_if(~F.col("email").rlike("^[a-z]+[.][a-z]+[0-9]+@[a-z.]+$")),
    ).first()
    assert str(row[0]) >= "1940-01-01" and str(row[1]) <= "2007-12-31"
    assert str(row[2]) >= "2015-01-01" and str(row[3]) < "2026-06-30"
    assert 0 <= row[4] and row[5] <= 5_000_000 and 0.76 < row[6] < 0.84 and row[7] == 8 and row[8] == 0
    british = df.filter("country_code = 'GB'").select("postal_code").first()[0]
    import re

    assert re.fullmatch("[A-Z]{2}[0-9] [0-9][A-Z]{2}", british)


def test_fixed_sample_reads_once_and_counts_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sample", "plan only")
    sample = fixed_sample(df, "o_orderkey", 50, 3)
    assert not jobs.getJobIdsForGroup("sample")  # nothing runs while planning
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "rangepartitioning" not in plan
    expected = sorted((r.d, r.o_orderkey) for r in df.select(draw(3, "sample", F.col("o_orderkey")).alias("d"), "o_orderkey").collect())[:50]
    assert {r.o_orderkey for r in sample.collect()} == {key for _, key in expected}
    spread = df.repartition(300)  # more tasks than groups
    assert sorted(map(tuple, fixed_sample(spread, "o_orderkey", 50, 3).collect())) == sorted(map(tuple, sample.collect()))
