"""Two rounds of exports: what loads, what is held and why, and how corrections close it."""

import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from onboarding_fixture import ROUND_1, ROUND_2, TENANTS, write, write_sheet

from pyspark.sql import functions as F

from ledgerloom.config import SourceFormat, lint
from ledgerloom.contracts import registry
from ledgerloom.plans import monitoring, staging
from ledgerloom.operators import reports
from ledgerloom.plans.onboarding import Onboarding
from ledgerloom.sources.files import discover, fingerprints
from ledgerloom.sources.tables import Tables

RUN_1, RUN_2 = dt.datetime(2024, 7, 6, 12), dt.datetime(2024, 7, 7, 12)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return tmp_path_factory.mktemp("landing")


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    root, reports = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("reports")
    return Onboarding(spark, str(root), registry(), TENANTS, str(reports))


@pytest.fixture(scope="module")
def first(spark, job, landing):
    write(landing, ROUND_1, 1_700_000_000)
    cells = write_sheet(spark, landing, 1_700_000_100)
    return {r.source_file: r for r in job.ingest(str(landing), cells, RUN_1).collect()}


def held(job):
    return {
        (r.tenant_id, r.feed, r.source_file, r.source_row): (
            r.record_key, [v["rule"] for v in json.loads(r.violations)], r.resolved_batch_id,
        )
        for r in job.quarantine().collect()
    }


def test_configuration_is_clean():
    assert lint(registry(), TENANTS) == []


def test_every_file_is_accounted_for(first, job):
    assert {n: (r.status, r.rows_loaded, r.rows_quarantined) for n, r in first.items()} == {
        "Facilities 1.csv": ("loaded_with_errors", 2, 3),
        "Roster.csv": ("loaded_with_errors", 1, 2),
        "POS week1.csv": ("loaded_with_errors", 1, 1),
        "POS week2.csv": ("rejected", 0, 1),
        "POS empty.csv": ("rejected", 0, 0),
        "Equipment.xlsx": ("loaded_with_errors", 1, 2),
        "batiments.csv": ("loaded_with_errors", 1, 1),
        "equipements.csv": ("loaded_with_errors", 1, 3),
    }
    assert first["Facilities 1.csv"].unmapped_columns == ["Notes"]
    assert all(r.report_path and os.path.isdir(f"{job.reports}/{r.report_path}") for r in first.values())


def test_what_is_held_and_why(first, job):
    got = {k[1:]: v[:2] for k, v in held(job).items()}
    assert got == {
        ("buildings", "Facilities 1.csv", 3): ("NW-2", ["required"]),
        ("buildings", "Facilities 1.csv", 5): ("NW-3", ["not_allowed"]),
        ("buildings", "Facilities 1.csv", 7): ("NW-1", ["duplicate_key"]),
        ("buildings", "batiments.csv", 4): ("FL-2", ["required"]),
        ("staff", "Roster.csv", 3): ("S-02", ["bad_format"]),
        ("staff", "Roster.csv", 4): ("S-03", ["required"]),
        ("commissary_transactions", "POS week1.csv", 3): (
            "R1|2", ["out_of_range", "invalid_type", "unknown_reference"],
        ),
        ("commissary_transactions", "POS week2.csv", 2): ("R2|1", ["missing_column"]),
        ("assets", "Equipment.xlsx", 6): ("T-0002", ["out_of_range", "held_reference"]),
        ("assets", "Equipment.xlsx", 7): ("T-0003", ["not_allowed", "invalid_type", "not_allowed"]),
        ("assets", "equipements.csv", 3): ("EQ-2", ["held_reference"]),
        ("assets", "equipements.csv", 4): ("EQ-3", ["invalid_type", "out_of_range", "unknown_reference"]),
        ("assets", "equipements.csv", 5): (None, ["required"]),
    }


def test_loaded_rows_are_typed_and_upgraded(first, job):
    assets = {r.asset_tag: r for r in job.raw("assets").collect()}
    assert set(assets) == {"T-0001", "EQ-1"}
    canot, canoe = assets["EQ-1"], assets["T-0001"]
    assert (str(canot.purchase_cost), canot.category, canot.status) == ("1450.50", "other", "in_service")
    assert (canot.purchased_on, canot._contract_version) == (dt.date(2020, 7, 4), 1)
    assert (str(canoe.purchase_cost), canoe.category) == ("1200.50", "watercraft")
    (sale,) = job.raw("commissary_transactions").collect()
    assert sale.sold_at == dt.datetime(2024, 7, 4, 18, 30)
    assert sale.payment_method == "camper_account"
    (chalet,) = job.raw("buildings").where("tenant_id = 'fleuve'").collect()
    assert (chalet.building_name, chalet.capacity) == ("Érables", 12)


def test_reports_use_the_tenants_own_columns(first, spark, job):
    base = f"{job.reports}/buildings/*/"
    listing = spark.read.option("header", True).csv(base + "rows_to_fix/*/tenant_id=fleuve/*/*/*.csv")
    assert listing.columns[:3] == ["Row in your file", "Code du bâtiment", "Nom"]
    (row,) = listing.collect()
    assert row[0] == "4" and row["What to fix"] == "Nom is blank, and every row needs one."
    titles = {r.title for r in spark.read.json(base + "problems").collect()}
    assert titles == {
        "Required values left blank", "Values we don't recognise", "Rows that appear twice",
    }
    (broken,) = spark.read.json(f"{job.reports}/commissary_transactions/*/batches").where(
        "source_file = 'POS empty.csv'"
    ).collect()
    assert [v["rule"] for v in broken.file_violations] == ["unreadable"]
    assert broken.file_violations[0]["message"] == "file is empty"


def test_same_files_again_are_skipped(first, job, landing, spark):
    assert job.pending(str(landing)).count() == 0
    assert job.ingest(str(landing), write_sheet(spark, landing, 1_700_000_100), RUN_1).count() == 0
    told = job.results().collect()
    assert {r.source_file for r in told} == set(first) and {r.status for r in told} == {"skipped"}
    assert {r.rows_received + r.rows_loaded + r.rows_quarantined + r.rows_resolved for r in told} == {0}


def test_corrections_close_the_quarantine(first, job, landing, spark):
    write(landing, ROUND_2, 1_700_001_000)
    before = job.tables.last()
    second = job.ingest(str(landing), None, RUN_2)
    statuses = {r.source_file: (r.status, r.rows_resolved) for r in second.collect()}
    assert statuses == {
        "Facilities 2.csv": ("loaded", 3),
        "Roster 2.csv": ("loaded", 2),
        "POS week3.csv": ("loaded", 2),
        "batiments 2.csv": ("loaded", 1),
        "equipements 2.csv": ("loaded", 2),
    }
    still_open = {(r.tenant_id, r.feed, r.record_key) for r in job.open_quarantine().collect()}
    # A row without a key can never be matched to a resend; the workbook was not sent again.
    assert still_open == {
        ("northwood", "assets", "T-0002"), ("northwood", "assets", "T-0003"), ("fleuve", "assets", None),
    }
    closed = [r for r in job.quarantine().collect() if r.resolved_batch_id]
    assert all(r.resolved_at > r.quarantined_at and r.resolved_batch_id != r.batch_id for r in closed)

    # Overlapping exports count once.
    sales = staging.stg_commissary_transactions(job.raw("commissary_transactions"))
    assert (job.raw("commissary_transactions").count(), sales.count()) == (4, 3)

    fixed = job.tables.read("resolutions", since=before + 1)
    summary = monitoring.run_summary(second, fixed).first().asDict()
    assert summary == dict(files=5, rejected=0, rows_loaded=14, rows_quarantined=0, rows_resolved=10)
    seed = spark.createDataFrame([("northwood", "North"), ("fleuve", "Fleuve")], "tenant_id string, camp_name string")
    quality = monitoring.mon_ingestion_quality(
        staging.stg_ingest_batches(job.batches()), staging.stg_quarantine(job.quarantine()), seed
    )
    status = {(r.camp_name, r.feed): r.asDict() for r in monitoring.ingestion_status(quality).collect()}
    assert status[("North", "commissary_transactions")] == dict(
        camp_name="North", feed="commissary_transactions", batches=4, files_rejected=2, rows_loaded=4,
        rows_quarantined=2, rows_resolved=2, rows_open=0,
    )


def test_a_run_that_died_is_repeated(spark, tmp_path):
    landing = tmp_path / "landing"
    write(landing, {k: v for k, v in ROUND_1.items() if "batiments" in k}, 1_700_000_000)
    job = Onboarding(spark, str(tmp_path / "raw"), registry(), TENANTS)
    commit, job.tables.commit = job.tables.commit, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        job.ingest(str(landing), None, RUN_1)
    assert job.batches().count() == 0 and job.raw("buildings").count() == 0
    job.tables.commit = commit
    assert [r.rows_loaded for r in job.ingest(str(landing), None, RUN_1).collect()] == [1]
    assert (job.raw("buildings").count(), job.quarantine().count()) == (1, 1)


def test_an_unknown_encoding_holds_up_no_other_tenant(spark, tmp_path):
    landing = tmp_path / "landing"
    write(landing, {k: v for k, v in ROUND_1.items() if "batiments" in k or "Facilities" in k}, 1_700_000_000)
    north, fleuve = TENANTS
    odd = replace(fleuve.feeds["buildings"], format=SourceFormat(encoding="klingon", delimiter=";"))
    tenants = [north, replace(fleuve, feeds={"buildings": odd})]
    assert lint(registry(), tenants) == ["fleuve/buildings: unknown encoding 'klingon'"]
    job = Onboarding(spark, str(tmp_path / "raw"), registry(), tenants)
    got = {r.source_file: (r.status, r.rows_loaded, r.rows_quarantined) for r in job.ingest(str(landing), None, RUN_1).collect()}
    assert got == {"Facilities 1.csv": ("loaded_with_errors", 2, 3), "batiments.csv": ("rejected", 0, 0)}
    assert {r.tenant_id for r in job.raw("buildings").collect()} == {"northwood"}


def test_what_a_dead_run_left_stays_invisible(spark, tmp_path):
    """The dead run had written assets; the repeat gives its number to a feed that loads earlier."""
    landing = tmp_path / "landing"
    write(landing, {k: v for k, v in ROUND_1.items() if "equipements" in k}, 1_700_000_000)
    write(landing, {k: v for k, v in ROUND_1.items() if "batiments" in k}, 1_700_000_100)
    waiting = landing / "fleuve" / "batiments.csv"
    later = waiting.read_bytes()
    waiting.unlink()
    job = Onboarding(spark, str(tmp_path / "raw"), registry(), TENANTS)
    commit, job.tables.commit = job.tables.commit, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        job.ingest(str(landing), None, RUN_1)
    job.tables.commit = commit
    waiting.write_bytes(later)
    job.ingest(str(landing), None, RUN_2).collect()
    audit = {r.feed: r.rows_loaded for r in job.batches().collect()}
    assert set(audit) == {"buildings", "assets"}
    for feed, loaded in audit.items():
        assert job.raw(feed).count() == loaded, feed
    keys = [(r.batch_id, r.source_row) for r in job.quarantine().collect()]
    assert len(keys) == len(set(keys))


def test_a_commit_shows_only_the_tables_of_its_run(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    gen = tables.begin()
    tables.write("stale", gen, spark.range(3))
    gen = tables.begin()
    tables.write("fresh", gen, spark.range(2))
    tables.commit(gen, RUN_1)
    assert tables.read("stale") is None and tables.read("fresh").count() == 2
    gen = tables.begin()
    tables.write("fresh", gen, spark.range(4).withColumn("more", F.lit("x")))
    tables.commit(gen, RUN_2)
    assert sorted(str(r.more) for r in tables.read("fresh", schema="id bigint, more string").collect()) == ["None"] * 2 + ["x"] * 4


def test_fingerprints_follow_content_alone(spark, tmp_path):
    texts = {"a": "x\ny\n" * 40_000, "b": "x\ny\n" * 40_000, "c": "y\nx\n" * 40_000, "d": "", "e": "x\ny\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    files = spark.createDataFrame([(str(tmp_path / n), len(t)) for n, t in texts.items()], "path string, file_size bigint")
    seen = []
    for split in ("128m", "10k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        seen.append({r.path[-1]: r.file_sha256 for r in fingerprints(spark, files).collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and seen[0]["a"] == seen[0]["b"]
    assert len(set(seen[0].values())) == 4


def test_listings_are_written_as_they_are(spark, tmp_path):
    schema = "tenant_id string, batch_id string, part int, nth bigint, c0 string, c1 string, c2 string"
    rows = [("t", "b1", 0, 2, "2", " a ", 'say "x"'), ("t", "b1", 0, -1, "\ufeffRow in your file", "Name", "Fix")]
    reports.write_listings(spark.createDataFrame(rows, schema), str(tmp_path / "out"))
    (part,) = (tmp_path / "out" / "tenant_id=t" / "batch_id=b1" / "part=0").glob("*.csv")
    assert part.read_bytes().decode("utf-8") == '\ufeffRow in your file,Name,Fix\n2, a ,"say ""x"""\n'


def test_each_part_of_a_long_listing_has_its_header(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(reports, "LINES_A_FILE", 3)
    contract = registry().get("buildings@1")
    rejected = spark.range(2, 9).selectExpr(
        "'t' || id % 2 as tenant_id", "'b' || id % 2 as batch_id", "id as source_row",
        "map('building_code', 'B-' || id) as raw", "array(named_struct('message', 'no. ' || id)) as violations",
        "array() as file_violations",
    )
    labels = {"t0": {"building_code": "Code"}, "t1": {"building_code": "Kode"}}
    reports.write_listings(reports.listings(rejected, contract, labels), str(tmp_path / "out"))
    seen = {}
    for path in (tmp_path / "out").glob("*/*/*/*.csv"):
        head, *rows = path.read_text("utf-8").splitlines()
        seen[path.parent.parent.parent.name, path.parent.name] = (head.split(",")[1], [r.split(",")[1] for r in rows])
    assert seen == {
        ("tenant_id=t0", "part=0"): ("Code", ["B-2"]), ("tenant_id=t0", "part=1"): ("Code", ["B-4"]),
        ("tenant_id=t0", "part=2"): ("Code", ["B-6", "B-8"]), ("tenant_id=t1", "part=1"): ("Kode", ["B-3", "B-5"]),
        ("tenant_id=t1", "part=2"): ("Kode", ["B-7"]),
    }


def test_only_files_of_a_tenant_and_pattern_are_found(spark, tmp_path):
    names = (
        "northwood/Facilities a.csv", "northwood/facilities.csv", "northwood/Facilities.csv.part",
        "northwood/old/Facilities.csv", "northwood/_Facilities.csv", "nobody/Facilities.csv",
        "fleuve/batiments[1] 100%+.csv", "Facilities.csv", "_events/x.json",
    )
    for name in names:
        path = tmp_path / "in [new]" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    found = discover(spark, str(tmp_path / "in [new]"), TENANTS).collect()
    assert {(r.tenant_id, r.feed, r.source_file, r.file_size) for r in found} == {
        ("northwood", "buildings", "Facilities a.csv", 1), ("fleuve", "buildings", "batiments[1] 100%+.csv", 1),
    }
    assert discover(spark, str(tmp_path / "not yet"), TENANTS).count() == 0


def test_a_tenants_rows_lie_in_its_own_folders(first, job):
    for rows in (job.raw("buildings"), job.quarantine(), job.open_quarantine()):
        mine = rows.where("tenant_id = 'fleuve'")
        assert mine.count() and {r.tenant_id for r in mine.collect()} == {"fleuve"}
    plan = job.raw("buildings").where("tenant_id = 'fleuve'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tenant_id" in plan


def test_listings_of_many_batches_are_written_side_by_side(spark, tmp_path):
    rows = [("t", f"b{i:02d}", 0, n, f"cell {n}") for i in range(40) for n in (1, -1)]
    lists = spark.createDataFrame(rows, "tenant_id string, batch_id string, part int, nth long, c0 string")
    reports.write_listings(lists, str(tmp_path / "lists"))
    files = list((tmp_path / "lists").rglob("part-*.csv"))
    assert len(files) == 40
    assert all(f.read_text() == "cell -1\ncell 1\n" for f in files)
    assert len({f.name.split("-")[1] for f in files}) > 1  # tasks
