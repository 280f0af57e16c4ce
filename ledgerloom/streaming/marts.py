"""Event marts kept up to date run by run, equal to a full rebuild whatever lands when.

A run lands copies, finds what they change, and rebuilds exactly the work orders and days that
were touched. Tables are versioned by run:

* ``events`` and the two event-grain facts gain rows. A stored event is replaced only when a copy
  that was *received* earlier *lands* later; ``superseded`` names those, and readers drop older
  versions of a superseded event. It is nearly always empty, so current rows need no shuffle.
* ``fct_work_orders`` and ``rpt_maintenance_daily`` gain the rebuilt version of each touched key;
  the newest version counts, and a key left without events gets a deletion mark.

So a run writes in proportion to what it touches, never to what is stored, and nothing is updated
in place. ``compact`` folds the versions together.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timeutil import ntz, utc_now
from ..plans.events import EVENT_COLUMNS, dedupe_events
from ..plans.facts import (
    LATE_MINUTES,
    fct_maintenance_events,
    fct_waterfront_checks,
    fct_work_orders,
)
from ..plans.reporting import rpt_maintenance_daily
from ..plans.staging import payload_rejects, stg_app_events
from ..sources.tables import GEN, Tables
from ..sources.uploads import RAW_EVENT_COLUMNS

DAY = ["tenant_id", "event_date_local"]
_BY_DAY = ["event_date_local"]


class EventMarts:
    def __init__(
        self, spark: SparkSession, root: str, tenants: DataFrame, late_minutes: int = LATE_MINUTES
    ):
        self.spark, self.tenants, self.late_minutes = spark, tenants, late_minutes
        self.tables = Tables(spark, root)

    # Reading

    def _live(self, versions: DataFrame | None, extra: DataFrame | None = None) -> DataFrame | None:
        """Versions of events that no later run superseded."""
        if versions is None:
            return None
        replaced = self.tables.read("superseded")
        for marks in (replaced, extra):
            if marks is not None:
                m = marks.select("event_id", F.col(GEN).alias("since"))
                versions = versions.join(
                    m,
                    (versions["event_id"] == m["event_id"]) & (m["since"] > versions[GEN]),
                    "left_anti",
                )
        return versions

    def _current(self, table: str) -> DataFrame:
        df = self._live(self.tables.read(table))
        if df is None:
            raise LookupError(f"{table}: no run has been committed yet")
        return df.drop(GEN)

    def landed(self) -> DataFrame:
        return self.tables.read("landed", history=True).drop(GEN)

    def rejects(self) -> DataFrame:
        """Uploaded copies with an unreadable payload or number."""
        return self.tables.read("rejects", history=True).drop(GEN)

    def events(self) -> DataFrame:
        return self._current("events")

    def maintenance_events(self) -> DataFrame:
        return self._current("fct_maintenance_events")

    def waterfront_checks(self) -> DataFrame:
        return self._current("fct_waterfront_checks")

    def work_orders(self) -> DataFrame:
        versions = self.tables.read("fct_work_orders")
        newest = Window.partitionBy("work_order_key").orderBy(F.col(GEN).desc())
        ranked = versions.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") == 1)
        return ranked.where(~F.col("_deleted")).drop("rn", GEN, "_deleted")

    def daily(self) -> DataFrame:
        """A day's rows all come from the run that last touched the day."""
        versions = self.tables.read("rpt_maintenance_daily")
        newest = Window.partitionBy("tenant_id", "activity_date").orderBy(F.col(GEN).desc())
        ranked = versions.withColumn("rn", F.rank().over(newest)).where(F.col("rn") == 1)
        return ranked.where(~F.col("_deleted")).drop("rn", GEN, "_deleted")

    # One run

    def run(self, copies: DataFrame, run_ts: dt.datetime | None = None, note: str = "") -> int:
        """Land uploaded copies and bring every mart up to date. Returns the generation.

        A note that was committed before makes the call a no-op, so a replayed micro-batch is
        harmless; a run that died before its commit is simply overwritten.
        """
        if note and note in self.tables.notes():
            return self.tables.last()
        run_ts, gen, t = run_ts or utc_now(), self.tables.begin(), self.tables

        t.write("landed", gen, copies.select(*RAW_EVENT_COLUMNS))
        landed = t.written("landed", gen)
        t.write("rejects", gen, payload_rejects(landed).drop(GEN))

        stored = self._stored(landed)
        t.write("events", gen, dedupe_events(stg_app_events(landed), stored, run_ts))
        changed = t.written("events", gen)
        t.write("superseded", gen, self._superseded(changed, stored))
        superseded = t.written("superseded", gen)

        t.write("tenants", gen, self.tenants.select("tenant_id"))
        news = changed.drop(GEN).unionByName(self._of_new_tenants(superseded, run_ts, changed))
        facts = fct_maintenance_events(news, self.tenants, self.late_minutes)
        t.write("fct_maintenance_events", gen, facts, _BY_DAY)
        t.write("fct_waterfront_checks", gen, fct_waterfront_checks(news, self.tenants))

        self._rebuild(gen, superseded, run_ts)
        t.commit(gen, run_ts, note)
        return gen

    def _stored(self, landed: DataFrame) -> DataFrame | None:
        """Live stored versions of the events that just landed: a scan of three columns, filtered
        by the ids at hand before anything is shuffled."""
        versions = self.tables.read("events")
        if versions is None:
            return None
        keys = versions.select("event_id", "received_at", "upload_id", GEN)
        return self._live(keys.join(landed.select("event_id").distinct(), "event_id", "left_semi"))

    def _superseded(self, changed: DataFrame, stored: DataFrame | None) -> DataFrame:
        if stored is None:
            return changed.limit(0).select("event_id")
        return stored.select("event_id").join(changed.select("event_id"), "event_id", "left_semi")

    def _of_new_tenants(
        self, superseded: DataFrame, run_ts: dt.datetime, changed: DataFrame
    ) -> DataFrame:
        """Stored events of tenants that were unknown when the events arrived."""
        none = changed.limit(0).drop(GEN)
        seen, versions = self.tables.read("tenants"), self.tables.read("events")
        if versions is None:
            return none
        latest = seen.where(F.col(GEN) == self.tables.last()).select("tenant_id")
        new = self.tenants.select("tenant_id").join(latest, "tenant_id", "left_anti")
        if new.isEmpty():
            return none
        waiting = self._live(versions, superseded).join(new, "tenant_id", "left_semi")
        return waiting.select(*EVENT_COLUMNS, ntz(run_ts).alias("_loaded_at"))

    def _rebuild(self, gen: int, superseded: DataFrame, run_ts: dt.datetime) -> None:
        t = self.tables
        new = t.written("fct_maintenance_events", gen)
        versions = t.read("fct_maintenance_events")
        coordinates = ["work_order_key", *DAY]
        touched = new.select(*coordinates)
        facts = new
        if versions is not None:
            # A replaced copy may have belonged to another work order or day: both are touched.
            live = self._live(versions)
            old = live.join(superseded.select("event_id"), "event_id", "left_semi")
            touched = touched.unionByName(old.select(*coordinates))
            facts = self._live(versions, superseded).unionByName(new)
        facts = facts.drop(GEN)
        t.write("touched", gen, touched.distinct())
        touched = t.written("touched", gen)

        keys = touched.select("work_order_key").distinct()
        orders = fct_work_orders(facts, keys).withColumn("_deleted", F.lit(False))
        gone = _without(keys, self._touched_facts(facts, keys, ["work_order_key"]), ["work_order_key"])
        t.write("fct_work_orders", gen, _with_marks(orders, gone))

        days = touched.select(*DAY).distinct()
        facts = _on_days(facts, days)
        daily = rpt_maintenance_daily(facts, days, run_ts).withColumn("_deleted", F.lit(False))
        gone = _without(days, self._touched_facts(facts, days, DAY), DAY)
        gone = gone.withColumnRenamed("event_date_local", "activity_date")
        t.write("rpt_maintenance_daily", gen, _with_marks(daily, gone))

    @staticmethod
    def _touched_facts(facts: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
        return facts.join(keys, on, "left_semi").select(*on)

    def compact(self, run_ts: dt.datetime | None = None) -> int:
        """Write the current state as one generation that replaces those before it."""
        t, run_ts = self.tables, run_ts or utc_now()
        gen = t.begin()
        live = F.lit(False).alias("_deleted")
        t.write("events", gen, self.events())
        t.write("fct_maintenance_events", gen, self.maintenance_events(), _BY_DAY)
        t.write("fct_waterfront_checks", gen, self.waterfront_checks())
        t.write("fct_work_orders", gen, self.work_orders().select("*", live))
        t.write("rpt_maintenance_daily", gen, self.daily().select("*", live))
        t.write("tenants", gen, t.read("tenants").where(F.col(GEN) == t.last()).drop(GEN))
        t.commit(gen, run_ts, base=gen)
        return gen


def _on_days(facts: DataFrame, days: DataFrame) -> DataFrame:
    """Prune the scan to the partitions between the first and the last touched day; the join that
    follows selects the days themselves. Two dates reach the driver."""
    day = F.col("event_date_local")
    first, last = days.agg(F.min(day), F.max(day)).first()
    return facts.where(day.between(F.lit(first), F.lit(last)))


def _without(keys: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    return keys.join(found, on, "left_anti")


def _with_marks(rows: DataFrame, gone: DataFrame) -> DataFrame:
    marks = gone.withColumn("_deleted", F.lit(True))
    return rows.unionByName(marks, allowMissingColumns=True)
