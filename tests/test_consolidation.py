"""Consolidation on hand-written rows: every reason, rule order, merge order, summary, publishing."""

import json

import pytest
from pyspark.sql import functions as F

from meldspark.plans import customers as plan
from meldspark.session import staged_tables
from meldspark.sinks import publish as publishing
from meldspark.sinks.publish import LostRace, RejectedPublish, current, publish
from meldspark.sources.countries import COUNTRIES, CountryEntry, country_dictionary, country_spellings

CRM = dict(
    customer_id="1", first_name="jan", last_name="NOWAK", email="Jan@Example.com", phone="", birth_date="1.2.1990",
    street="Polna 1", city=" ", postal_code="00-001", country="Poland", registered_at="2020-01-02 03:04:05",
    active="Y", lifetime_value="12,345",
)
WEBSHOP = dict(
    id="1", firstName="Jan", lastName="Nowak", email="shop@example.com", phone="+48", birthDate="1990-02-01",
    address=dict(street="S", city="C", zip="Z", countryCode="pl"), createdAt="2020-01-02T03:04:05Z", active="true",
    ltv="10.5",
)
LEGACY = dict(
    member_id="1", name="Nowak, Jan", contact=dict(email="old@example.com", phone=None), born="1990/02/01",
    location=dict(street="S", city="C", postcode="Z", country="polska"), joined="2020-01-02 03:04:05",
    status="ACTIVE", value="-0.01",
)
CRM_SCHEMA = "source_row long, " + ", ".join(f"{c} string" for c in plan.CRM_COLUMNS)


def raw(spark, crm=(), webshop=(), legacy=()):
    def rows(base, changes, schema):
        data = [dict(base, source_row=i + 1, **change) for i, change in enumerate(changes)]
        lines = spark.createDataFrame([(json.dumps(d),) for d in data], "j string")
        return lines.select(F.from_json("j", schema).alias("r")).select("r.*")

    return (
        rows(CRM, [], CRM_SCHEMA) if not crm else rows({}, [dict(CRM, **c) for c in crm], CRM_SCHEMA),
        rows({}, [dict(WEBSHOP, **c) for c in webshop], "source_row long, " + plan.WEBSHOP_SCHEMA),
        rows({}, [dict(LEGACY, **c) for c in legacy], "source_row long, " + plan.LEGACY_SCHEMA),
    )


def checked(spark, **sources):
    return plan.check_rows(plan.unite_sources(*raw(spark, **sources)))


def reasons(spark, **sources):
    rows = checked(spark, **sources).orderBy("source_priority", "source_row").collect()
    return [r.reject_reason for r in rows]


def test_clean_row(spark):
    row = checked(spark, crm=[{}]).first()
    assert (row.customer_id, row.first_name, row.last_name, row.email) == (1, "Jan", "Nowak", "jan@example.com")
    assert (row.phone, row.city, row.country_code, str(row.lifetime_value)) == (None, None, "PL", "12.35")
    assert (str(row.birth_date), str(row.registered_at), row.is_active) == ("1990-02-01", "2020-01-02 03:04:05", True)
    assert row.reject_reason is None


CRM_CASES = [
    ("missing or invalid customer_id", dict(customer_id=None)),
    ("missing or invalid customer_id", dict(customer_id="")),
    ("missing or invalid customer_id", dict(customer_id="abc")),
    ("missing or invalid customer_id", dict(customer_id="9223372036854775808")),
    (None, dict(customer_id="12.5")),
    ("missing name", dict(first_name=None)),
    ("missing name", dict(last_name="   ")),
    ("missing email", dict(email="  ")),
    ("invalid email", dict(email="a@b")),
    ("invalid email", dict(email="a b@c.de")),
    ("invalid email", dict(email="a@b.co\n")),
    (None, dict(email="A@B.CO")),
    (None, dict(email="a@b.co")),
    *[("invalid birth_date", dict(birth_date=t)) for t in ("unknown", "", "00.00.0000", "1990-02-31", "n/a", "31.02.1990")],
    (None, dict(birth_date=" 1.2.1990 ")),
    ("unknown country", dict(country="Atlantis")),
    ("invalid registered_at", dict(registered_at="2020-01-02 03:04")),
    ("invalid registered_at", dict(registered_at="2020-01-02 24:00:00")),
    ("invalid registered_at", dict(registered_at="2020-01-02T03:04:05Z")),
    ("invalid active flag", dict(active="X")),
    (None, dict(active=" y ")),
    *[("invalid lifetime_value", dict(lifetime_value=t)) for t in ("12.34.56", "N/A", "1.234,50", "12345678901")],
    ("negative lifetime_value", dict(lifetime_value="-0,01")),
    ("missing name", dict(first_name="", email="", birth_date="", country="?", lifetime_value="-1")),
    ("invalid email", dict(email="x", lifetime_value="N/A")),
]


def test_reasons_in_rule_order(spark):
    assert reasons(spark, crm=[change for _, change in CRM_CASES]) == [reason for reason, _ in CRM_CASES]


def test_reasons_of_the_other_sources(spark):
    found = reasons(
        spark,
        webshop=[dict(active="1"), dict(active="maybe"), dict(createdAt="2020-01-02 03:04:05"), dict(address=None)],
        legacy=[dict(value="5"), dict(), dict(name="Solo", value="5"), dict(contact=None), dict(status="pending"),
                dict(status=" inactive ", value="5")],
    )
    assert found == [
        None, "invalid active flag", "invalid registered_at", "unknown country",
        None, "negative lifetime_value", "missing name", "missing email", "invalid active flag", None,
    ]


def test_every_spelling_is_known(spark):
    spellings = [s for c in COUNTRIES for s in (c.code, c.name, c.native_name, *c.variants)]
    changes = [dict(country=f"  {case(s)} ") for s in spellings for case in (str.upper, str.lower, str.title)]
    rows = checked(spark, crm=changes).orderBy("source_row").collect()
    expected = [c.code for c in COUNTRIES for _ in (c.code, c.name, c.native_name, *c.variants) for _ in range(3)]
    assert [r.country_code for r in rows] == expected


def test_own_dictionary_and_contested_spellings(spark):
    entries = [CountryEntry("AA", "Alpha", "Alpha", ("Both",), "1", "#"), CountryEntry("BB", "Beta", "Beta", (" both",), "2", "#")]
    dictionary = country_dictionary(spark, entries)
    assert {tuple(r) for r in country_spellings(dictionary).collect()} == {
        ("aa", "AA"), ("alpha", "AA"), ("bb", "BB"), ("beta", "BB"), ("both", "BB")
    }
    parsed = plan.unite_sources(*raw(spark, crm=[dict(country="BOTH "), dict(country="Poland")]))
    rows = plan.check_rows(parsed, dictionary).orderBy("source_row").collect()
    assert [(r.country_code, r.reject_reason) for r in rows] == [("BB", None), (None, "unknown country")]


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_merge_order(spark, partitions):
    sources = raw(
        spark,
        crm=[dict(customer_id="2", first_name="late"), dict(customer_id="1", email="bad"),
             dict(customer_id="2", first_name="later"), dict(customer_id="4")],
        webshop=[dict(id="1", firstName="shop"), dict(id="2"), dict(id="3", firstName="b"), dict(id="3", firstName="a")],
        legacy=[dict(member_id=str(i), value="1") for i in (1, 2, 3, 5)] + [dict(member_id="6")],
    )
    result = plan.consolidate(*[s.repartition(partitions) for s in sources])
    rows = {r.customer_id: (r.first_name, r.sources) for r in result.customer.collect()}
    assert rows == {
        1: ("Shop", "legacy,webshop"), 2: ("Late", "crm,legacy,webshop"), 3: ("B", "legacy,webshop"),
        4: ("Jan", "crm"), 5: ("Jan", "legacy"),
    }
    rejected = sorted(map(tuple, result.rejected_row.collect()))
    assert rejected == [("crm", 2, "1", "invalid email"), ("legacy", 5, "6", "negative lifetime_value")]
    assert [tuple(r) for r in result.summary.collect()] == [
        ("rows_read", "crm", 4), ("rows_read", "webshop", 4), ("rows_read", "legacy", 5),
        ("rejected", "invalid email", 1), ("rejected", "negative lifetime_value", 1),
        ("valid_rows", "", 11), ("merged_duplicates", "", 6), ("customers_loaded", "", 5),
    ]


def test_publish_replaces_all_tables_or_none(spark, tmp_path):
    root = str(tmp_path / "published")
    first = plan.consolidate(*raw(spark, crm=[{}, dict(customer_id="2")]))
    plan.publish_customers(first, root)
    assert current(spark, root, "customer").count() == 2
    second = plan.consolidate(*raw(spark, crm=[{}]))
    plan.publish_customers(second, root)
    assert current(spark, root, "customer").count() == 1
    broken = second._replace(customer=second.customer.unionByName(second.customer).withColumn("country_code", F.lit("XX")))
    with pytest.raises(RejectedPublish) as error:
        plan.publish_customers(broken, root)
    assert "customer key: 1 (2 rows)" in str(error.value) and "customer country: XX (2 rows)" in str(error.value)
    assert current(spark, root, "customer").count() == 1
    assert current(spark, root, "country").count() == len(COUNTRIES)


def test_nothing_published(spark, tmp_path):
    with pytest.raises(LookupError):
        current(spark, str(tmp_path / "none"), "customer")
    publish({"t": spark.range(3)}, str(tmp_path / "one"))
    assert current(spark, str(tmp_path / "one"), "t").count() == 3


def test_all_violations_are_written(spark, tmp_path):
    root = str(tmp_path / "published")
    found = spark.range(50).selectExpr("'check' AS check", "CAST(id AS STRING) AS key", "id AS rows")
    with pytest.raises(RejectedPublish) as error:
        publish({"t": spark.range(1)}, root, lambda tables: found)
    path = str(error.value).split("all in ")[1].split(";")[0]
    assert "50 violations" in str(error.value) and spark.read.json(path).count() == 50
    publish({"t": spark.range(1)}, root, lambda tables: found.limit(0))
    assert current(spark, root, "t").count() == 1


def test_one_of_two_publishers_wins(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "published")
    publish({"t": spark.range(1)}, root)
    stale = publishing._newest(spark, root)
    publish({"t": spark.range(2)}, root)
    with monkeypatch.context() as patch:
        patch.setattr(publishing, "_newest", lambda *_: stale)
        with pytest.raises(LostRace):
            publish({"t": spark.range(3)}, root)
    assert current(spark, root, "t").count() == 2


def test_files_are_staged_once(spark, tmp_path):
    (tmp_path / plan.CRM_FILE).write_text(";".join(plan.CRM_COLUMNS) + "\n" + ";".join(CRM.values()) + "\nx" + ";" * 12 + "\n")
    (tmp_path / plan.WEBSHOP_FILE).write_text(json.dumps(WEBSHOP) + "\n")
    entry = '- member_id: 9\n  name: "A, B"\n  contact:\n    email: "a@b.co"\n  born: "1990/02/01"\n'
    entry += '  location:\n    country: "polska"\n  joined: "2020-01-02 03:04:05"\n  status: "active"\n  value: 1\n'
    (tmp_path / plan.LEGACY_FILE).write_text(entry)
    before = len(staged_tables())
    report = plan.run_job(spark, str(tmp_path), str(tmp_path / "out"))
    assert len(staged_tables()) - before == 1 and report.summary.count() > 0  # the summary alone is left
    assert report.comparison is None
    assert {r.customer_id: r.sources for r in current(spark, str(tmp_path / "out"), "customer").collect()} == {
        1: "crm,webshop", 9: "legacy"
    }
    rejected = current(spark, str(tmp_path / "out"), "rejected_row").collect()
    assert [tuple(r) for r in rejected] == [("crm", 2, "x", "missing or invalid customer_id")]


def test_manifest_in_the_sources_folder_is_compared(spark, tmp_path):
    summary = spark.createDataFrame(
        [("rows_read", "crm", 3), ("customers_loaded", "", 2)], "metric string, item string, rows long"
    )
    text = '{"unique_customers": 3, "sources": {"crm": {"file": "c.csv", "records": 3}, "webshop": {"records": 4}}}'
    (tmp_path / "m.json").write_text(text)
    manifest = spark.read.schema(plan.MANIFEST_SCHEMA).json(str(tmp_path / "m.json"))
    assert sorted(map(tuple, plan.compare_with_manifest(summary, manifest).collect())) == [
        ("customers_loaded", "", 3, 2), ("rows_read", "crm", 3, 3), ("rows_read", "webshop", 4, 0)
    ]


def test_old_runs_go_and_readers_of_the_last_one_stay(spark, tmp_path):
    import os

    from meldspark.sinks.publish import remove_old_runs

    root = str(tmp_path / "kept")
    runs = [publish({"t": spark.range(n), "u": spark.range(1)}, root) for n in (1, 2, 3)]
    reader = spark.read.parquet(f"{root}/t/{runs[1]}")
    with pytest.raises(RejectedPublish):
        publish({"t": spark.range(9)}, root, lambda tables: spark.createDataFrame([("c", "k", 1)], "check string, key string, rows long"))
    left = set(os.listdir(f"{root}/t")) - set(runs)
    assert remove_old_runs(spark, root) == [runs[0]]  # what has no commit may still be at work
    assert reader.count() == 2 and current(spark, root, "t").count() == 3
    assert set(os.listdir(f"{root}/u")) == set(runs[1:]) and left <= set(os.listdir(f"{root}/t"))
    assert set(remove_old_runs(spark, root, keep=1, hours=0)) == {runs[1], *left}
    assert os.listdir(f"{root}/t") == [runs[2]] and os.listdir(f"{root}/violations") == []
    publish({"t": spark.range(4)}, root)
    assert current(spark, root, "t").count() == 4
    assert remove_old_runs(spark, str(tmp_path / "nothing")) == []
    with pytest.raises(ValueError):
        remove_old_runs(spark, root, keep=0)
