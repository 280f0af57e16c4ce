"""Small hand-checked cases for keys, time, dimensions, facts, monitors, access, checks, upgrades."""

import datetime as dt
import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom import contracts
from ledgerloom.config import Contract, ContractError, Registry, Tenant, lint
from ledgerloom.functions.keys import NULL_PART, nullable_key, record_key, surrogate_key
from ledgerloom.functions.text import normalize, normalize_py
from ledgerloom.functions.timeutil import boundaries_between, local_date
from ledgerloom.operators import access, checks, quarantine
from ledgerloom.operators.dedupe import best_per_key, latest_per_key
from ledgerloom.operators.lookup import lookup
from ledgerloom.operators.mapping import config_frame, file_layouts, map_columns
from ledgerloom.operators.upgrade import upgrade
from ledgerloom.plans import dims, facts, monitoring, reporting, staging
from ledgerloom.sources import cells as cell_source
from ledgerloom.sources.seeds import TENANT_ACCESS, TENANTS, read_seed
from ledgerloom.config import SourceFormat

T = dt.datetime


def md5(*parts):
    return hashlib.md5("-".join(NULL_PART if p is None else p for p in parts).encode()).hexdigest()


def test_keys(spark):
    df = spark.createDataFrame([("t", "a", 1), ("t", None, None)], "t string, c string, n int")
    got = df.select(
        surrogate_key("t", "c").alias("k"), nullable_key("t", "c").alias("o"), record_key("c", "n").alias("r")
    ).collect()
    assert [tuple(r) for r in got] == [(md5("t", "a"), md5("t", "a"), "a|1"), (md5("t", None), None, None)]


def test_boundaries_and_local_days(spark):
    rows = [
        (T(2024, 1, 1, 0, 0, 59), T(2024, 1, 1, 0, 1, 1), 1),
        (T(2024, 3, 10, 1, 59), T(2024, 3, 10, 3, 1), 62),  # a gap in the session's own zone
        (T(2024, 1, 1, 0, 1), T(2024, 1, 1, 0, 0, 59), -1),
        (T(1965, 1, 1, 0, 0, 59), T(1965, 1, 1, 0, 1), 1),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, n bigint")
    assert df.where(boundaries_between("minute", "a", "b") != F.col("n")).isEmpty()
    assert df.select(boundaries_between("hour", "a", "b").alias("h")).collect()[1].h == 2
    zones = spark.createDataFrame(
        [(T(2024, 3, 10, 4, 59), "America/New_York"), (T(2024, 3, 10, 4, 59), "Asia/Tokyo")],
        "t timestamp_ntz, z string",
    )
    days = [r.d for r in zones.select(local_date("t", "z").alias("d")).collect()]
    assert days == [dt.date(2024, 3, 9), dt.date(2024, 3, 10)]


def test_normalize_agrees_on_both_sides(spark):
    texts = ["  Bldg   CODE ", "Bâtiment No", "Straße", "a\tb\nc", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(normalize(F.col("t")).alias("n")).collect()] == list(map(normalize_py, texts))


def test_normalize_folds_all_of_unicode(spark):
    """Every character that Unicode 3.2 had, as every runtime in use agrees on these, and words in which the
    place of a letter matters."""
    old = unicodedata.ucd_3_2_0.category
    chars = [c for c in map(chr, range(0x30000)) if old(c) not in ("Cn", "Cs") and c.strip() and normalize_py(c)]
    words = [f"a{c} {c}b" for c in chars] + ["ΟΔΟΣ ΣΟΦΟΣ", "οδος σοφος", "eﬃcient ﬁle", "İstanbul", "STRASSE ẞ ß", "ŉ ΐ ῼ"]
    df = spark.createDataFrame([(t, normalize_py(t)) for t in words], "t string, folded string")
    wrong = df.where(normalize(F.col("t")) != F.col("folded")).collect()
    assert wrong == []


def test_latest_version_and_map_side_limit(spark):
    rows = [("t", "a", T(2024, 1, 1), 1, "old"), ("t", "a", T(2024, 1, 2), 1, "x"), ("t", "a", T(2024, 1, 2), 2, "new")]
    df = spark.createDataFrame(rows, "tenant_id string, k string, _loaded_at timestamp_ntz, _source_row int, v string")
    best = latest_per_key(df, ["k"])
    assert [r.v for r in best.collect()] == ["new"]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_lookup_keeps_every_row(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("k"), "id").unionByName(
        spark.createDataFrame([(None, 5000), ("cold", 5001)], "k string, id bigint")
    )
    unique = spark.createDataFrame([("hot", 1), ("other", 2)], "k string, v int")
    out = lookup(rows, unique, ["k"])
    assert out.count() == 1002 and out.where("v = 1").count() == 1000


def tenants(spark):
    return spark.createDataFrame([("t1", "America/New_York")], "tenant_id string, timezone string")


def event_rows(spark, rows):
    schema = "event_id string, tenant_id string, building_code string, asset_tag string, staff_code string, reported_by_staff_code string"
    return spark.createDataFrame(rows, schema)


def test_inferred_members(spark):
    ev = event_rows(spark, [
        ("1", "t1", "B1", "A1", None, "S1"), ("2", "t1", "B2", "A9", "S2", None),
        ("3", "t1", "B3", "A9", "S2", None), ("4", "nobody", "B9", "A1", "S1", None), ("5", "t1", None, None, None, None),
    ])
    b = spark.createDataFrame([("t1", "B1", "Birch", "cabin", 4, 1990)], "tenant_id string, building_code string, building_name string, building_type string, capacity int, year_built int")
    got = {r.building_code: (r.building_name, r.is_inferred) for r in dims.dim_building(b, ev, tenants(spark)).collect()}
    assert got == {"B1": ("Birch", False), "B2": ("Unknown building B2", True), "B3": ("Unknown building B3", True)}
    a = spark.createDataFrame([], "tenant_id string, asset_tag string, asset_name string, asset_category string, asset_status string, building_code string, purchased_on date, purchase_cost decimal(12,2)")
    got = {r.asset_tag: (r.building_code, r.asset_name) for r in dims.dim_asset(a, ev, tenants(spark)).collect()}
    assert got == {"A1": ("B1", "Unknown asset A1"), "A9": ("B3", "Unknown asset A9")}
    s = spark.createDataFrame([("t1", "S2", "Ann", "Lee", "admin", None, dt.date(2024, 1, 1), True)], "tenant_id string, staff_code string, first_name string, last_name string, staff_role string, email string, start_date date, is_active boolean")
    got = {r.staff_code: (r.staff_role, r.is_inferred) for r in dims.dim_staff(s, ev, tenants(spark)).collect()}
    assert got == {"S1": ("unknown", True), "S2": ("admin", False)}


def test_calendar(spark):
    days = dims.dim_date(spark, dt.date(2024, 2, 29)).collect()
    assert (days[0].date_day, days[-1].date_day) == (dt.date(2024, 1, 1), dt.date(2026, 2, 27))
    sunday = next(d for d in days if d.date_day == dt.date(2024, 1, 7))
    assert (sunday.day_of_week, sunday.is_weekend, sunday.month) == (0, True, 1)
    assert len(days) == len({d.date_day for d in days})


def test_water_ranges_are_three_valued(spark):
    df = spark.createDataFrame(
        [(1.0, 7.2), (4.1, 7.5), (2.0, 7.9), (None, 6.4), (None, 9.0), (None, None), (5.0, None), (2.0, None)],
        "cl double, ph double",
    )
    got = [r.x for r in df.select(facts.water_out_of_range(F.col("cl"), F.col("ph")).alias("x")).collect()]
    assert got == [False, True, True, True, False, None, True, None]


def raw_event(i, action, at, received, payload="{}", upload="u"):
    return (f"e{i}", "t1", "d", i, f"work_order.{action}", at, received, f"{upload}{i}", payload)


RAW = "event_id string, tenant_id string, device_id string, device_seq int, event_type string, occurred_at timestamp_ntz, received_at timestamp_ntz, upload_id string, payload string"


def test_payload_keeps_exact_numbers_and_survives_bad_ones(spark):
    at = T(2024, 1, 1)
    raw = spark.createDataFrame([
        raw_event(1, "completed", at, at, '{"parts_cost": 12.10, "labor_minutes": 30}'),
        raw_event(2, "completed", at, at, '{"parts_cost": "x", "labor_minutes": 1.5, "work_order_id": "W"}'),
        raw_event(3, "completed", at, at, '{"parts_cost": null}'),
        raw_event(4, "completed", at, at, '{broken'),
    ], RAW)
    got = {r.event_id: (str(r.parts_cost), r.labor_minutes, r.work_order_id) for r in staging.stg_app_events(raw).collect()}
    assert got == {"e1": ("12.100000", 30, None), "e2": ("None", None, "W"), "e3": ("None", None, None), "e4": ("None", None, None)}
    bad = {r.event_id: r.unreadable_fields for r in staging.payload_rejects(raw).collect()}
    assert bad == {"e2": ["labor_minutes", "parts_cost"], "e4": ["payload"]}


def test_freshness(spark):
    raw = spark.createDataFrame([raw_event(1, "opened", T(2024, 1, 1), T(2024, 1, 3))], RAW)
    stale = lambda when, df=raw: monitoring.source_freshness(df, when).first().is_stale
    assert (stale(T(2024, 1, 5)), stale(T(2024, 1, 5, 0, 1)), stale(T(2024, 1, 5), raw.limit(0))) == (False, True, True)


def test_report_keeps_events_without_a_building(spark):
    fct = spark.createDataFrame(
        [("t1", dt.date(2024, 1, 1), None, "completed", None, 5, None, False)],
        "tenant_id string, event_date_local date, building_key string, event_action string, priority string, labor_minutes int, parts_cost decimal(28,6), is_late_arrival boolean",
    )
    (row,) = reporting.rpt_maintenance_daily(fct).collect()
    assert (row.building_key, row.work_orders_completed, row.labor_minutes, row.parts_cost) == (None, 1, 5, 0)


@pytest.mark.parametrize(("role", "seen"), [("r1", {"t1"}), ("nobody", set()), ("platform_admin", {"t1", "t2"})])
def test_tenant_view(spark, role, seen):
    df = spark.createDataFrame([("t1",), ("t2",)], "tenant_id string")
    grants = spark.createDataFrame([("r1", "t1"), ("R1", "t2")], TENANT_ACCESS)
    assert {r.tenant_id for r in access.tenant_view(df, role, grants).collect()} == seen


def test_unscoped_tables_must_say_so(spark):
    with pytest.raises(access.TenantScopeError):
        access.tenant_view(spark.range(1), "r1", spark.createDataFrame([], TENANT_ACCESS))
    assert access.tenant_view(spark.range(1), "r1", None, tenant_scoped=False).count() == 1


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, None)], "k int, v string")
    assert [r.k for r in checks.unique(df, "k").collect()] == [1]
    assert checks.not_null(df, "v").count() == 1
    assert checks.accepted_values(df, "v", ["a"]).count() == 1
    assert checks.accepted_range(df, "k", min_value=2).count() == 2
    assert checks.relationships(df, "k", df.limit(0), "k").count() == 2


def test_upgrade(spark):
    registry = contracts.registry()
    v1 = spark.createDataFrame([("A-1", "Canoe", "B", None, 1450.0)], "asset_tag string, asset_name string, building_code string, purchased_on date, purchase_price double")
    (row,) = upgrade(v1, registry.get("assets@1"), registry).collect()
    assert (str(row.purchase_cost), row.category, row.status) == ("1450.00", "other", "in_service")
    assert set(row.asDict()) == set(registry.latest("assets").fields)
    with pytest.raises(ContractError):
        registry.get("assets@9")
    broken = Registry.from_dicts([contracts.ASSETS_1, {**contracts.ASSETS_2, "upgrade_from": {}}])
    with pytest.raises(ContractError):
        upgrade(v1, broken.get("assets@1"), broken)


def test_contracts_and_lint():
    registry = contracts.registry()
    order = registry.load_order()
    assert order.index("buildings") < order.index("assets") < 4 and order[-1] == "commissary_transactions"
    assert registry.latest("assets").version == 2
    with pytest.raises(ContractError):
        Contract.from_dict({"feed": "x", "version": 1, "primary_key": ["k"], "fields": {"k": {"type": "blob"}}})
    feed = {"contract": "staff@1", "files": "*", "columns": {"X": "nope"}, "values": {"role": {"a": "king"}}}
    bad = Tenant.from_dict({"tenant_id": "t", "timezone": "UTC", "feeds": {"staff": feed}})
    found = " ".join(lint(registry, [bad]))
    assert "unknown field nope" in found and "required field staff_code" in found and "king" in found


def test_headers_match_loosely_and_short_rows_are_padded(spark):
    feed = {"contract": "buildings@1", "files": "*", "columns": {"Bldg Code": "building_code", "Type": "building_type", "Beds": "capacity"}, "values": {"building_type": {"Dining Hall": "dining"}}}
    tenant = Tenant.from_dict({"tenant_id": "t", "timezone": "UTC", "feeds": {"buildings": feed}})
    files = spark.createDataFrame([("b", "t", "buildings", "/f", "f", T(2024, 1, 1))], "batch_id string, tenant_id string, feed string, path string, source_file string, loaded_at timestamp_ntz")
    heads = spark.createDataFrame([("/f", "/f", ["bldg   code", "TYPE", "Notes", "TYPE", ""])], "file_path string, path string, headers array<string>")
    rows = spark.createDataFrame([("/f", 2, ["TP-1", "dining hall", "x", "Yurt"]), ("/f", 3, ["TP-2", " Dining  Hall"])], "file_path string, source_row bigint, cells array<string>")
    layout = file_layouts(files, heads, config_frame(spark, [tenant]))
    (info,) = layout.collect()
    assert (info.missing_columns, info.unmapped_columns) == (["Beds"], ["Notes"])
    got = {r.source_row: r.raw for r in map_columns(rows, layout).collect()}
    assert got == {2: {"building_code": "TP-1", "building_type": "Yurt"}, 3: {"building_code": "TP-2", "building_type": "dining"}}


def test_typed_cells(spark):
    def sheet(path, name, rows):
        return [(path, name, 0, n, c, k, t) for n, row in enumerate(rows, 1) for c, (k, t) in enumerate(row)]

    data = sheet("/a", "Assets", [[("text", "title")], [("text", "Tag "), ("text", "Cost")], [("text", "A"), ("int", "80")], [(None, None)], [("text", "B")]])
    data += sheet("/b", "Other", [[("text", "x")]]) + sheet("/c", "Assets", [[("text", "only")]])
    records, headers, errors = cell_source.read_cells(spark.createDataFrame(data, cell_source.CELL_SCHEMA), SourceFormat("excel", sheet="Assets", header_row=2))
    assert {(r.file_path, tuple(r.headers)) for r in headers.collect()} == {("/a", ("Tag", "Cost"))}
    assert sorted((r.source_row, r.cells, r.kinds) for r in records.collect()) == [(3, ["A", "80"], ["text", "int"]), (5, ["B"], ["text"])]
    assert {r.path: r.message for r in errors.collect()} == {"/b": "no sheet named 'Assets' (found: Other)", "/c": "header row 2 not found"}


def test_resolution_takes_the_next_load_only(spark):
    def at(day):
        return T(2024, 1, day)

    held = spark.createDataFrame(
        [("t", "f", "k", "b1", 2, at(1)), ("t", "f", "k", "b3", 2, at(3)), ("t", "f", "k", "b3", 9, at(3)), ("t", "f", None, "b1", 3, at(1)), ("t", "f", "z", "b1", 4, at(1)), ("u", "f", "k", "b5", 2, at(5))],
        "tenant_id string, feed string, record_key string, batch_id string, source_row bigint, quarantined_at timestamp_ntz",
    )
    loaded = spark.createDataFrame(
        [("t", "f", "k", "b0", T(2023, 1, 1)), ("t", "f", "k", "b2", at(2)), ("t", "f", "k", "b3", at(3)), ("t", "f", "k", "b4", at(4)), ("t", "f", "k", "b5", at(5)), ("u", "f", "k", "b5", at(5))],
        "tenant_id string, feed string, record_key string, batch_id string, loaded_at timestamp_ntz",
    )
    closed = quarantine.resolutions(held, loaded)
    assert {(r.batch_id, r.source_row, r.resolved_batch_id, r.resolved_at.day) for r in closed.collect()} == {("b1", 2, "b2", 2), ("b3", 2, "b4", 4), ("b3", 9, "b4", 4)}
    still = quarantine.open_rows(held, closed)
    assert {(r.tenant_id, r.record_key) for r in still.collect()} == {("t", None), ("t", "z"), ("u", "k")}


def test_seeds(spark, tmp_path):
    (tmp_path / "tenants.csv").write_text("tenant_id,camp_name,country,region,timezone,onboarded_on\nt,Chêne,CA,QC,America/Toronto,2026-04-06\n")
    (row,) = dims.dim_tenant(read_seed(spark, str(tmp_path / "tenants.csv"), TENANTS)).collect()
    assert (row.camp_name, row.onboarded_on) == ("Chêne", dt.date(2026, 4, 6))


def test_best_per_key_is_total(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert sorted(r.id for r in best_per_key(df, ["k"], [F.col("id").desc()]).collect()) == [97, 98, 99]
