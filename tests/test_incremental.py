"""Landing in stages gives what one rebuild gives, in any landing order."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.timeutil import ntz
from ledgerloom.plans import events, facts, reporting, staging
from ledgerloom.sources import uploads as up
from ledgerloom.streaming.marts import EventMarts
from ledgerloom.streaming.stream import start, thin_copies

RAW = """event_id string, tenant_id string, device_id string, device_seq int, event_type string,
occurred_at timestamp_ntz, received_at timestamp_ntz, upload_id string, payload string"""
ZONES = {"pines": "America/New_York", "fleuve": "Europe/Paris"}
START = dt.datetime(2024, 3, 8, 20)


def season(seed, n=160):
    """Copies of events with retries, delays, fast clocks, and retries that disagree."""
    rng, copies = random.Random(seed), []
    for i in range(n):
        tenant, order = rng.choice(list(ZONES)), f"W{rng.randint(0, 25)}"
        action = rng.choice(["opened", "assigned", "started", "completed", "check"])
        at = START + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 6), seconds=rng.randint(0, 59))
        received = at + dt.timedelta(minutes=rng.choice([0, 1, 30, 61, 600, 6000]))
        if rng.random() < 0.1:
            at = received + dt.timedelta(hours=3)
        for copy in range(rng.choice([1, 1, 2, 3])):
            if copy and rng.random() < 0.3:
                order = f"W{rng.randint(0, 25)}"  # the retry names another work order
            payload = {"work_order_id": order, "building_code": f"B{rng.randint(0, 3)}"}
            kind = f"work_order.{action}"
            if action == "opened":
                payload |= {"priority": rng.choice(["urgent", "low"]), "category": "hvac", "reported_by": "S1"}
            elif action == "completed":
                payload |= {"labor_minutes": rng.randint(1, 90), "parts_cost": "12.50", "staff_code": "S2"}
            elif action == "check":
                kind = "waterfront.check_logged"
                payload = {"check_id": f"C{i}", "building_code": "B1", "ph": 7.1, "chlorine_ppm": None}
            copies.append(
                (
                    f"E{i}", tenant, "d1", i, kind, at,
                    received + dt.timedelta(minutes=copy * rng.choice([0, 5, 3000])),
                    f"U{i}-{rng.randint(0, 9)}-{copy}", json.dumps(payload),
                )
            )
    return copies


def tenants(spark, names=tuple(ZONES)):
    return spark.createDataFrame([(n, ZONES[n]) for n in names], "tenant_id string, timezone string")


def rebuilt(spark, copies, tens):
    ev = events.dedupe_events(staging.stg_app_events(spark.createDataFrame(copies, RAW)))
    fct = facts.fct_maintenance_events(ev, tens)
    return {
        "events": ev,
        "facts": fct,
        "orders": facts.fct_work_orders(fct),
        "checks": facts.fct_waterfront_checks(ev, tens),
        "daily": reporting.rpt_maintenance_daily(fct),
    }


def same(marts, want):
    got = {
        "events": marts.events(),
        "facts": marts.maintenance_events(),
        "orders": marts.work_orders(),
        "checks": marts.waterfront_checks(),
        "daily": marts.daily(),
    }
    for name, df in want.items():
        columns = sorted(df.columns)
        a = sorted(map(repr, got[name].select(*columns).collect()))
        b = sorted(map(repr, df.select(*columns).collect()))
        assert a == b, name


@pytest.mark.parametrize(("seed", "in_order"), [(1, True), (2, False), (3, False)])
def test_staged_runs_match_a_rebuild(spark, tmp_path, seed, in_order):
    rng, copies = random.Random(seed), season(seed)
    copies.sort(key=(lambda c: c[6]) if in_order else (lambda c: rng.random()))
    cuts = [0, *sorted(rng.sample(range(1, len(copies)), 3)), len(copies)]
    marts = EventMarts(spark, str(tmp_path / "marts"), tenants(spark))
    replaced = 0
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        marts.run(spark.createDataFrame(copies[a:b], RAW))
        marks = marts.tables.read("superseded")
        replaced += marks.count() if marks is not None else 0
        if i == 2:
            marts.compact()
    same(marts, rebuilt(spark, copies, tenants(spark)))
    assert marts.landed().count() == len(copies)
    assert marts.events().count() == len({c[0] for c in copies})
    assert (replaced > 0) == (not in_order)


def test_a_tenant_that_joins_later_gets_its_history(spark, tmp_path):
    copies = season(4, 80)
    marts = EventMarts(spark, str(tmp_path / "marts"), tenants(spark, ["pines"]))
    marts.run(spark.createDataFrame(copies[:90], RAW))
    marts.tenants = tenants(spark)
    marts.run(spark.createDataFrame(copies[90:], RAW))
    same(marts, rebuilt(spark, copies, tenants(spark)))


def test_a_run_that_died_leaves_no_trace(spark, tmp_path):
    copies = season(5, 60)
    marts = EventMarts(spark, str(tmp_path / "marts"), tenants(spark))
    marts.run(spark.createDataFrame(copies[:40], RAW), note="a 0")
    commit, marts.tables.commit = marts.tables.commit, lambda *a, **k: 1 / 0
    with pytest.raises(ZeroDivisionError):
        marts.run(spark.createDataFrame(copies[40:], RAW), note="a 1")
    same(marts, rebuilt(spark, copies[:40], tenants(spark)))
    marts.tables.commit = commit
    marts.run(spark.createDataFrame(copies[40:], RAW), note="a 1")
    marts.run(spark.createDataFrame(copies[40:], RAW), note="a 1")  # replayed after its commit
    same(marts, rebuilt(spark, copies, tenants(spark)))
    assert marts.landed().count() == len(copies)


def envelopes(copies):
    """One upload per device and time, payloads as JSON objects."""
    return [
        {
            "upload_id": c[7], "tenant_id": c[1], "device_id": c[2], "received_at": c[6].isoformat(),
            "events": [
                {
                    "event_id": c[0], "device_id": c[2], "device_seq": c[3], "event_type": c[4],
                    "occurred_at": c[5].isoformat(), "payload": json.loads(c[8]),
                }
            ],
        }
        for c in copies
    ]


def test_stream_of_upload_files(spark, tmp_path):
    copies = season(6, 60)
    folder = tmp_path / "uploads"
    folder.mkdir()
    marts = EventMarts(spark, str(tmp_path / "marts"), tenants(spark))
    for n, part in enumerate((copies[60:], copies[:60])):
        (folder / f"{n}.jsonl").write_text("\n".join(map(json.dumps, envelopes(part))) + "\n")
        query = start(spark, str(folder), str(tmp_path / "ckpt"), marts, max_files=1)
        query.awaitTermination(300)
        assert query.exception() is None
    same(marts, rebuilt(spark, copies, tenants(spark)))


def test_deliver_lands_each_upload_once(spark, tmp_path):
    copies = season(7, 40)
    path = tmp_path / "u.jsonl"
    path.write_text("\n".join(map(json.dumps, envelopes(copies))) + "\n")
    sent = up.read_uploads(spark, str(path))
    until = sorted(c[6] for c in copies)[20]
    first = up.upload_rows(up.pending_uploads(sent, None, until)).cache()
    assert first.count() == sum(c[6] <= until for c in copies)
    rest = up.upload_rows(up.pending_uploads(sent, first))
    assert first.unionByName(rest).count() == len(copies)
    want = spark.createDataFrame(copies, RAW).select("event_id", "upload_id", "occurred_at", "received_at")
    got = first.unionByName(rest).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    up.write_uploads(sent, str(tmp_path / "again"))
    assert up.read_uploads(spark, str(tmp_path / "again")).exceptAll(sent).isEmpty()


def test_lookback_reads_everything_when_the_target_is_empty(spark):
    stg = staging.stg_app_events(spark.createDataFrame(season(8, 30), RAW))
    stored = events.dedupe_events(stg)
    assert events.since_lookback(stg, stored.limit(0)).count() == stg.count()
    high = stored.agg(F.max("received_at")).first()[0] - dt.timedelta(days=3)
    assert events.since_lookback(stg, stored).count() == stg.where(F.col("received_at") >= ntz(high)).count()


def test_high_water_mark(spark):
    stg = staging.stg_app_events(spark.createDataFrame(season(9, 30), RAW))
    old = events.dedupe_events(stg.where("device_seq < 10"), run_ts=dt.datetime(2024, 5, 1))
    new = events.dedupe_events(stg.where("device_seq >= 10"), run_ts=dt.datetime(2024, 5, 2))
    both = old.unionByName(new)
    assert events.added_since(both, old).count() == new.count() == 20
    assert events.added_since(both, old.limit(0)).count() == events.added_since(both, None).count() == 30


def test_thinning_drops_copies_within_the_horizon(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    rows = [("E1", "t", "d", 1, "x.y", at, at + dt.timedelta(hours=h), f"U{h}", "{}") for h in (0, 1, 2)]
    spark.createDataFrame(rows, RAW).write.parquet(str(tmp_path / "in"))
    copies = spark.readStream.schema(RAW).parquet(str(tmp_path / "in"))
    query = (
        thin_copies(copies)
        .writeStream.format("memory")
        .queryName("thinned")
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert spark.table("thinned").count() == 1
