"""Bucketed marts fed by the streaming job: any landing order gives what one rebuild gives."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from test_incremental import envelopes, rebuilt, same, season, tenants

from ledgerloom.streaming.bucketed import BUCKET, BucketedMarts, start


def land(folder, name, copies):
    """Files are taken in the order of their times."""
    folder.mkdir(exist_ok=True)
    path = folder / f"{name}.jsonl"
    path.write_text("\n".join(map(json.dumps, envelopes(copies))) + "\n")
    at = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(path, (at, at))


def run(spark, tmp_path, marts, **options):
    query = start(spark, str(tmp_path / "uploads"), str(tmp_path / "ckpt"), marts, max_files=1, **options)
    query.awaitTermination(600)
    assert query.exception() is None


def marts_of(spark, tmp_path, tens=None, buckets=8):
    return BucketedMarts(spark, str(tmp_path / "marts"), tens or tenants(spark), buckets)


@pytest.mark.parametrize(("seed", "in_order"), [(1, True), (2, False)])
def test_any_landing_order_matches_a_rebuild(spark, tmp_path, seed, in_order):
    rng, copies = random.Random(seed), season(seed)
    copies.sort(key=(lambda c: c[6]) if in_order else (lambda c: rng.random()))
    cuts = [0, *sorted(rng.sample(range(1, len(copies)), 3)), len(copies)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        land(tmp_path / "uploads", str(i), copies[a:b])
    marts = marts_of(spark, tmp_path)
    run(spark, tmp_path, marts)
    stored = spark.read.parquet(str(tmp_path / "marts" / "events"))
    assert (stored.where("replaces").count() > 0) == (not in_order)
    assert marts.events().count() == len({c[0] for c in copies})
    same(marts, rebuilt(spark, copies, tenants(spark)))


def test_marks_bring_a_new_object_up_to_date(spark, tmp_path):
    """Each run by a new object, that knows nothing but the marks; each twice."""
    copies = season(3, 120)
    random.Random(3).shuffle(copies)
    for n, part in enumerate((copies[:100], copies[100:])):
        land(tmp_path / "uploads", str(n), part)
        run(spark, tmp_path, marts_of(spark, tmp_path), refresh=False)
        marts_of(spark, tmp_path).refresh()
        marts_of(spark, tmp_path).refresh()
    same(marts_of(spark, tmp_path), rebuilt(spark, copies, tenants(spark)))


@pytest.mark.parametrize(
    ("dies_in", "part"), [("facts_by_day", "facts"), ("fct_work_orders", "orders"), ("rpt_maintenance_daily", "daily")]
)
def test_a_run_that_dies_is_completed_by_the_next(spark, tmp_path, dies_in, part):
    copies = season(5, 60)
    random.Random(5).shuffle(copies)

    def one():
        return BucketedMarts(spark, str(tmp_path / "marts"), tenants(spark), 4, marts=[dies_in])

    land(tmp_path / "uploads", "0", copies[:60])
    run(spark, tmp_path, one())
    land(tmp_path / "uploads", "1", copies[60:])
    marts = one()
    run(spark, tmp_path, marts, refresh=False)
    write = marts._write

    def half(table, rows, by, append=False):
        if table == dies_in and append:  # some rows are there, the others are not
            write(table, rows.where(F.xxhash64("event_id") % 2 == 0), by, append)
        if table == dies_in:
            raise ZeroDivisionError
        write(table, rows, by, append)

    marts._write = half
    with pytest.raises(ZeroDivisionError):
        marts.refresh()
    one().refresh()
    same(one(), {part: rebuilt(spark, copies, tenants(spark))[part]})


def test_a_tenant_that_joins_later_gets_its_history(spark, tmp_path):
    copies = season(4, 80)
    land(tmp_path / "uploads", "0", copies[:90])
    run(spark, tmp_path, marts_of(spark, tmp_path, tenants(spark, ["pines"])))
    land(tmp_path / "uploads", "1", copies[90:])
    run(spark, tmp_path, marts_of(spark, tmp_path))
    same(marts_of(spark, tmp_path), rebuilt(spark, copies, tenants(spark)))


def test_compacted_tables_hold_the_same(spark, tmp_path):
    copies = season(6, 60)
    for n in range(3):
        land(tmp_path / "uploads", str(n), copies[n::3])
    marts = marts_of(spark, tmp_path)
    run(spark, tmp_path, marts)
    marts.compact("facts_by_order", BUCKET)
    marts.compact("facts_by_day", "event_date_local")
    same(marts, rebuilt(spark, copies, tenants(spark)))


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "uploads").mkdir()
    marts = marts_of(spark, tmp_path)
    run(spark, tmp_path, marts)
    with pytest.raises(LookupError):
        marts.events()


def bytes_read(df):
    """Of the files a scan opens."""
    files = [r[0] for r in df.select(F.input_file_name()).distinct().collect()]
    return sum(os.path.getsize(f.removeprefix("file://")) for f in files)


def test_a_small_run_reads_a_small_part(spark, tmp_path):
    """A late copy of events in one of 100 work orders: under 5 % of the facts' bytes are read."""
    at, rows = dt.datetime(2024, 5, 1), []
    for i in range(3000):
        seen = at + dt.timedelta(minutes=i)
        payload = json.dumps({"work_order_id": f"W{i % 100}", "building_code": f"B{i}", "category": "x" * 20})
        rows.append((f"E{i}", "pines", "d", i, "work_order.started", seen, seen, f"U{i}", payload))
    late = [(f"L{r[0]}", *r[1:7], "late", r[8]) for r in rows if json.loads(r[8])["work_order_id"] == "W7"][:2]
    land(tmp_path / "uploads", "0", rows)
    run(spark, tmp_path, marts_of(spark, tmp_path, buckets=200))
    before = set((tmp_path / "marts" / "fct_work_orders").rglob("*.parquet"))
    land(tmp_path / "uploads", "1", late)
    marts, read = marts_of(spark, tmp_path, buckets=200), []
    pruned = marts.facts_of_orders
    marts.facts_of_orders = lambda buckets: read.append((buckets, pruned(buckets))) or read[-1][1]
    run(spark, tmp_path, marts, refresh=False)
    marts._ended = max(r[0] for r in spark.read.parquet(str(tmp_path / "marts/events")).select("landed").distinct().collect()) - 1
    marts.refresh()
    ((buckets, scan),) = read
    assert len(buckets) == 1
    assert bytes_read(scan) < 0.05 * bytes_read(marts._read("facts_by_order"))
    after = set((tmp_path / "marts" / "fct_work_orders").rglob("*.parquet"))
    assert {f.parent.name for f in after ^ before} == {f"bucket={buckets[0]}"}
    same(marts, rebuilt(spark, rows + late, tenants(spark)))


def test_a_commit_stores_changes_not_the_whole_state(spark, tmp_path):
    copies = season(5, 60)
    land(tmp_path / "uploads", "0", copies)
    marts = marts_of(spark, tmp_path)
    run(spark, tmp_path, marts, refresh=False)
    assert list((tmp_path / "ckpt" / "state").rglob("1.changelog"))
    assert not list((tmp_path / "ckpt" / "state").rglob("1.zip"))
    assert marts.events().count() == len({c[0] for c in copies})
