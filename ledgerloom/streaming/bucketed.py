"""Event marts that read and write in proportion to what lands.

Copies of an event meet in the state store of one streaming aggregation, keyed by event id and unbounded
in time: a micro-batch looks up the ids that landed and no others. What it decides is written under
``events/landed=<microseconds of the micro-batch>``, which a replayed micro-batch overwrites with the same
rows. Every mart is plain parquet and takes its work from there, from its own high-water mark on, which is
a literal in the scan's partition filter; no mart relies on what is in memory, so that one that died is
brought up to date by the next run:

* ``facts_by_day`` and ``checks`` (by local day) and ``facts_by_order`` (by a hash bucket of the work order)
  gain rows. A version that an earlier received copy replaces is taken out of its own partition.
* ``fct_work_orders`` (same buckets) and ``rpt_maintenance_daily`` (by day) are rebuilt for the buckets and
  days that were touched, from pruned scans, and overwritten partition by partition.

Rows appear mart by mart; all agree when a run ends. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import surrogate_key
from ..functions.timeutil import local_date
from ..plans.events import EVENT_COLUMNS, with_lag
from ..plans.facts import LATE_MINUTES, fct_maintenance_events, fct_waterfront_checks, fct_work_orders
from ..plans.reporting import rpt_maintenance_daily
from ..plans.staging import stg_app_events
from ..sources.uploads import stream_uploads, upload_rows

_STATE = "spark.sql.streaming.stateStore"
#: A commit stores the changes of its micro-batch, not the files of the state, which follow in the background;
#: and a row is put without looking it up once more only to count rows.
STATE_SETTINGS = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
}
_ORIGIN = dt.datetime(1970, 1, 1)
_MICROSECOND = dt.timedelta(microseconds=1)
LANDED, BUCKET, DAY = "landed", "bucket", "event_date_local"
#: Marts, each with the fact table it is built from, if any.
NEEDS = {
    "facts_by_day": None, "facts_by_order": None, "checks": None,
    "fct_work_orders": "facts_by_order", "rpt_maintenance_daily": "facts_by_day",
}
#: What of a copy decides where its facts are.
_PLACE = ["tenant_id", "work_order_id", "event_at"]


def winners(copies: DataFrame) -> DataFrame:
    """Streaming: for each event that landed its earliest received copy, whether that is a new one, whether
    it takes the place of a stored one, and the places of all its copies so far.

    Runs in update mode. Copies equal in received_at and upload_id are one; it stays the one that landed
    first."""
    stamped = with_lag(stg_app_events(copies)).withColumn(LANDED, F.unix_micros(F.current_timestamp()))
    rest = [c for c in EVENT_COLUMNS if c not in ("event_id", "received_at", "upload_id")]
    first = F.min(F.struct("received_at", "upload_id", LANDED, *rest)).alias("w")
    seen = stamped.groupBy("event_id").agg(
        first, F.min(LANDED).alias("since"), F.max(LANDED).alias("now"), F.collect_set(F.struct(*_PLACE)).alias("places")
    )
    return seen.select(
        "event_id",
        *[F.col(f"w.{c}").alias(c) for c in EVENT_COLUMNS if c != "event_id"],
        (F.col(f"w.{LANDED}") == F.col("now")).alias("is_new"),
        ((F.col(f"w.{LANDED}") == F.col("now")) & (F.col("since") < F.col("now"))).alias("replaces"),
        "places",
        F.col("now").alias(LANDED),
    )


def wall_time(micros: Column) -> Column:
    """Naive UTC time of microseconds since 1970, whatever the session's zone."""
    return F.lit(_ORIGIN).cast("timestamp_ntz") + F.make_dt_interval(secs=micros / F.lit(1_000_000).cast("decimal(18,6)"))


def high_water(target: DataFrame | None, mark: str = "_loaded_at") -> int | None:
    """The greatest mark in a target, in microseconds; None if it has no rows. One scalar."""
    high = None if target is None else target.agg(F.max(mark).alias("h")).first()["h"]
    return None if high is None else (high.replace(tzinfo=None) - _ORIGIN) // _MICROSECOND


class BucketedMarts:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        tenants: DataFrame,
        buckets: int = 64,
        late_minutes: int = LATE_MINUTES,
        marts: Iterable[str] = tuple(NEEDS),
        by_marks: bool = False,
    ):
        """``buckets``: partitions of the work-order marts. A run reads and writes those its orders fall
        into; choose it so that one holds some hundred MB. It must not change afterwards. ``marts``: those
        to keep, each with what it is built from. ``by_marks``: ask the marks in every run, as a process of
        its own does; else what this object has seen finish is not read again."""
        self.spark, self.root, self.tenants = spark, root.rstrip("/"), tenants
        self.buckets, self.late_minutes, self.by_marks = buckets, late_minutes, by_marks
        self.marts = {m for m in marts} | {NEEDS[m] for m in marts if NEEDS[m]}
        self._ended: int | None = None  # the last micro-batch that all marts have, as far as this object knows

    # Plain tables

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, files: str = "*=*") -> DataFrame | None:
        """A table, or None while it has no partition (``files``: no file of that pattern)."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._path(table)}/{files}")
        if not found.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(found):
            return None
        return self.spark.read.parquet(self._path(table))

    def _write(self, table: str, rows: DataFrame, by: str, append: bool = False) -> None:
        """Append, or replace exactly the partitions that have rows here."""
        writer = rows.write.partitionBy(by)
        if append:
            writer.mode("append").parquet(self._path(table))
        else:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self._path(table))

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    # Reading

    def _stored(self, table: str, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of a mart; what ``build`` makes of no events while it has none."""
        rows = self._read(table)
        rows = build(self.events().limit(0)) if rows is None else rows
        return rows.where(F.col(key).isNotNull())  # the rest marks partitions that were emptied

    def events(self) -> DataFrame:
        """Exactly one row per event. Replaced versions are few and are taken out by their ids."""
        rows = self._read("events")
        if rows is None:
            raise LookupError("events: nothing has been run yet")
        return self._live(rows).select(*EVENT_COLUMNS, wall_time(F.col(LANDED)).alias("_loaded_at"))

    @staticmethod
    def _live(rows: DataFrame) -> DataFrame:
        marks = rows.where("replaces").groupBy("event_id").agg(F.max(LANDED).alias("last"))
        new = rows.where("is_new")
        return new.join(marks, (new["event_id"] == marks["event_id"]) & (new[LANDED] < marks["last"]), "left_anti")

    def maintenance_events(self) -> DataFrame:
        return self._stored("facts_by_day", "event_id", self._maintenance)

    def waterfront_checks(self) -> DataFrame:
        return self._stored("checks", "event_id", self._checks)

    def work_orders(self) -> DataFrame:
        rows = self._stored("fct_work_orders", "work_order_key", lambda e: fct_work_orders(self._maintenance(e)))
        return rows.drop(BUCKET)

    def daily(self) -> DataFrame:
        def build(events: DataFrame) -> DataFrame:
            return rpt_maintenance_daily(self._maintenance(events), run_ts=_ORIGIN)

        return self._stored("rpt_maintenance_daily", "tenant_id", build)

    # One run

    def land(self, batch: DataFrame) -> None:
        """Store what a micro-batch decided. Replayed, it writes the same partition again."""
        self._write("events", batch.hint("rebalance"), LANDED)

    def refresh(self) -> None:
        """Bring every mart up to date with the stored events, each from its own mark on."""
        stored = self._read("events")
        if stored is None:
            return
        joined = self._joined()
        newest = stored.agg(F.max(LANDED)).first()[0]
        events = {
            "facts_by_day": (DAY, self._maintenance),
            "facts_by_order": (BUCKET, self._by_order),
            "checks": ("checked_date_local", self._checks),
        }
        for table, (by, build) in events.items():
            if table in self.marts:
                self._append(table, by, stored, joined, build)
        if "fct_work_orders" in self.marts:
            self._orders(stored, joined)
        if "rpt_maintenance_daily" in self.marts:
            self._daily(stored, joined, newest)
        self._ended = None if self.by_marks else newest
        if joined or self._read("tenants", "part-*") is None:
            self.tenants.select("tenant_id").write.mode("overwrite").parquet(self._path("tenants"))

    def _joined(self) -> list[str]:
        """Tenants that were unknown when the last run ended; the list of tenants is given and bounded."""
        known = self._read("tenants", "part-*")
        if known is None:
            return []
        return [r["tenant_id"] for r in self.tenants.join(known, "tenant_id", "left_anti").collect()]

    def _since(self, stored: DataFrame, target: DataFrame | None, mark: str = "_loaded_at") -> DataFrame:
        """Stored decisions that a target may lack, by its own high-water mark.

        The mark's own micro-batch is read again, as a run that died half way may have left the mark
        without the rest; only what this object itself has finished is not."""
        if self._ended is not None:
            return stored.where(F.col(LANDED) > F.lit(self._ended))
        high = high_water(target, mark)
        return stored if high is None else stored.where(F.col(LANDED) >= F.lit(high))

    # Event-grain facts

    def _maintenance(self, events: DataFrame) -> DataFrame:
        return fct_maintenance_events(events, self.tenants, self.late_minutes)

    def _by_order(self, events: DataFrame) -> DataFrame:
        return self._maintenance(events).withColumn(BUCKET, self._bucket(F.col("work_order_key")))

    def _checks(self, events: DataFrame) -> DataFrame:
        return fct_waterfront_checks(events, self.tenants)

    def _append(
        self, table: str, by: str, stored: DataFrame, joined: list[str], build: Callable[[DataFrame], DataFrame]
    ) -> None:
        target = self._read(table)
        rows = self._live(self._since(stored, target))
        if joined:
            theirs = self._live(stored).where(F.col("tenant_id").isin(joined))
            rows = rows.unionByName(theirs).dropDuplicates(["event_id"])
        events = rows.select(*EVENT_COLUMNS, wall_time(F.col(LANDED)).alias("_loaded_at"))
        facts = build(events)
        if target is not None:
            replacing = rows.where("replaces").select("event_id", wall_time(F.col(LANDED)).alias("at"))
            if not replacing.isEmpty():
                self._take_out(table, by, target, replacing)
            if joined or self._ended is None:
                facts = facts.join(self._present(table, events, joined), "event_id", "left_anti")
        self._write(table, facts.hint("rebalance", F.col(by)), by, append=True)

    def _present(self, table: str, events: DataFrame, joined: list[str]) -> DataFrame:
        """The tie rule: ids of the events at hand that the target has from a run that did not end. They carry
        its mark, which prunes the lookup."""
        have = self._read(table).where(F.col("event_id").isNotNull()).select("event_id", "_loaded_at")
        high = high_water(have)
        if high is not None and not joined:
            have = have.where(F.col("_loaded_at") >= wall_time(F.lit(high)))
        return have.join(events.select("event_id", "_loaded_at"), ["event_id", "_loaded_at"], "left_semi").select("event_id")

    def _take_out(self, table: str, by: str, target: DataFrame, newer: DataFrame) -> None:
        """Rewrite the partitions that hold an older version of an event without it. Ids are looked up by two
        columns, only in a run that replaces anything; the values of a partition column are bounded."""
        old = (target["event_id"] == newer["event_id"]) & (target["_loaded_at"] < newer["at"])
        values = [r[by] for r in target.join(newer, old, "left_semi").select(by).distinct().collect()]
        if values:
            kept = target.where(F.col(by).isin(values)).join(newer, old, "left_anti")
            self._write(table, self._with_marks(kept, by, values), by)

    def _with_marks(self, rows: DataFrame, by: str, values: Iterable) -> DataFrame:
        """A row of nulls for each partition value, so that one which is left without rows is replaced too."""
        kind = rows.schema[by].dataType
        marks = self.spark.range(1).select(F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias(by))
        live = rows.where(F.col(rows.columns[0]).isNotNull())
        return live.unionByName(marks, allowMissingColumns=True).hint("rebalance", F.col(by))

    # Marts that are rebuilt where they are touched

    def _touched(self, rows: DataFrame, stored: DataFrame, what: Column, joined: list[str]) -> list:
        """The distinct partition values that new winners, in any of their copies, touch."""
        rows = rows.where("is_new")
        if joined:
            rows = rows.unionByName(stored.where(F.col("tenant_id").isin(joined)))
        rows = rows.where("event_entity = 'work_order' or size(places) > 1")
        place = rows.select(F.explode("places").alias("p")).select("p.*").distinct()
        zoned = place.join(self.tenants.select("tenant_id", "timezone"), "tenant_id")
        return sorted(r["v"] for r in zoned.select(what.alias("v")).distinct().collect())

    def _orders(self, stored: DataFrame, joined: list[str]) -> None:
        rows = self._since(stored, self._read("fct_work_orders"))
        key = surrogate_key("tenant_id", "work_order_id")
        touched = self._touched(rows, stored, self._bucket(key), joined)
        facts = self.facts_of_orders(touched)
        if facts is not None and touched:
            orders = fct_work_orders(facts).withColumn(BUCKET, self._bucket(F.col("work_order_key")))
            self._write("fct_work_orders", self._with_marks(orders, BUCKET, touched), BUCKET)

    def facts_of_orders(self, buckets: list[int]) -> DataFrame | None:
        """The facts of the work orders in some buckets: a scan of their partitions alone."""
        facts = self._read("facts_by_order")
        return None if facts is None else facts.where(F.col(BUCKET).isin(buckets) & F.col("event_id").isNotNull())

    def facts_of_days(self, days: list[dt.date]) -> DataFrame | None:
        facts = self._read("facts_by_day")
        return None if facts is None else facts.where(F.col(DAY).isin(days) & F.col("event_id").isNotNull())

    def _daily(self, stored: DataFrame, joined: list[str], newest: int) -> None:
        rows = self._since(stored, self._read("rpt_maintenance_daily"), "_refreshed_at")
        touched = self._touched(rows, stored, local_date("event_at", "timezone"), joined)
        facts = self.facts_of_days(touched)
        if facts is not None and touched:
            daily = rpt_maintenance_daily(facts, run_ts=_ORIGIN + newest * _MICROSECOND)
            self._write("rpt_maintenance_daily", self._with_marks(daily, "activity_date", touched), "activity_date")

    def compact(self, table: str, by: str) -> None:
        """Write each partition of an appended table as few files."""
        rows = self._read(table)
        if rows is not None:
            self._write(table, rows.hint("rebalance", F.col(by)), by)


def start(
    spark: SparkSession, folder: str, checkpoint: str, marts: BucketedMarts, max_files: int = 1000, refresh: bool = True
) -> StreamingQuery:
    """Process everything that has arrived in micro-batches of at most ``max_files`` files, then stop. Event
    ids are kept in RocksDB state under the checkpoint. ``refresh=False`` stores events only; the marts
    are then brought up to date by ``marts.refresh()`` whenever that is wanted."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)

    def land(batch: DataFrame, epoch: int) -> None:
        marts.land(batch)
        if refresh:
            marts.refresh()

    return (
        winners(upload_rows(stream_uploads(spark, folder, max_files)))
        .writeStream.outputMode("update")
        .foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
