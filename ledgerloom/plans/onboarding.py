"""Landing files of all tenants -> raw feeds, quarantine, audit and reports.

One step per feed, in dependency order; a step handles every tenant and file of that feed in the
same few jobs. What a step writes becomes visible with its commit, so a run that dies is simply
repeated: batch ids derive from content, and files of committed steps are recognised by their
fingerprint.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Contract, Registry, SourceFormat, Tenant
from ..functions.keys import record_key
from ..functions.timeutil import ntz, utc_now
from ..operators import quarantine as q
from ..operators.mapping import config_frame, file_layouts, map_columns, parse_profiles
from ..operators.reports import listings, needs_report, violation_groups, write_listings
from ..operators.upgrade import upgrade
from ..operators.validate import (
    VIOLATION,
    batch_status,
    is_accepted,
    missing_columns,
    reference_status,
    unreadable,
    validate,
)
from ..session import staged
from ..sources.cells import read_cells
from ..sources.delimited import read_delimited, same_path, unusable
from ..sources.files import discover, fingerprints, new_files
from ..sources.tables import Tables

BATCHES = """batch_id string, tenant_id string, feed string, contract string, source_file string,
file_sha256 string, rows_received bigint, rows_loaded bigint, rows_quarantined bigint, status string,
started_at timestamp_ntz, finished_at timestamp_ntz, report_path string, rows_resolved bigint,
unmapped_columns array<string>"""
QUARANTINE = """batch_id string, tenant_id string, feed string, source_file string, source_row bigint,
record_key string, record string, violations string, quarantined_at timestamp_ntz"""
RESOLUTIONS = """tenant_id string, feed string, batch_id string, source_row bigint,
resolved_batch_id string, resolved_at timestamp_ntz"""
LINEAGE = (
    "_batch_id string, _source_file string, _source_row bigint, _contract_version int, "
    "_loaded_at timestamp_ntz"
)


def raw_schema(latest: Contract) -> str:
    fields = ", ".join(f"{f.name} {f.spark_type}" for f in latest.fields.values())
    return f"tenant_id string, {fields}, {LINEAGE}"


def _union(frames: list[DataFrame], schema: str, spark: SparkSession) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _keep(df: DataFrame) -> DataFrame:
    return staged(df, "validated")


class Onboarding:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        registry: Registry,
        tenants: Iterable[Tenant],
        reports: str | None = None,
    ):
        self.spark, self.registry, self.reports = spark, registry, reports
        self.tenants = list(tenants)
        self.tables = Tables(spark, root)
        self.profiles = parse_profiles(self.tenants)
        self.config = config_frame(spark, self.tenants)

    # What is in the raw layer

    def _read(self, table: str, schema: str) -> DataFrame:
        df, none = self.tables.read(table, schema=schema), self.spark.createDataFrame([], schema)
        return none if df is None else df.select(*none.columns)

    def raw(self, feed: str) -> DataFrame:
        return self._read(f"raw_{feed}", raw_schema(self.registry.latest(feed)))

    def batches(self) -> DataFrame:
        return self._read("ingest_batches", BATCHES)

    def _held(self) -> DataFrame:
        return self._read("quarantine", QUARANTINE)

    def _closed(self) -> DataFrame:
        return self._read("resolutions", RESOLUTIONS)

    def quarantine(self) -> DataFrame:
        return q.with_resolution(self._held(), self._closed())

    def open_quarantine(self, tenant: str | None = None) -> DataFrame:
        return q.open_quarantine(self._held(), self._closed(), tenant)

    # One run

    def pending(self, landing: str) -> DataFrame:
        """Files not ingested before, with their fingerprint."""
        return new_files(self._landed(landing), self.batches())

    def _landed(self, landing: str) -> DataFrame:
        return fingerprints(self.spark, discover(self.spark, landing, self.tenants))

    def ingest(
        self, landing: str, cells: DataFrame | None = None, run_at: dt.datetime | None = None
    ) -> DataFrame:
        """Ingest everything new under ``landing``. ``cells`` holds the content of spreadsheet
        files (see ``sources.cells``). Returns the batches of this run; :meth:`results` has the
        skipped files as well."""
        run_at = run_at or utc_now()
        landed = staged(self._landed(landing), "landed")
        files = staged(self._batches_of(new_files(landed, self.batches()), run_at), "files")
        self._skipped = landed.join(files.select("feed", "path"), ["feed", "path"], "left_anti")
        present = {(r["feed"], r["tenant_id"]) for r in files.select("feed", "tenant_id").distinct().collect()}
        before = self.tables.last()
        for feed in self.registry.load_order():
            tenants = [t for t in self.tenants if (feed, t.tenant_id) in present]
            if tenants:
                self._ingest_feed(feed, tenants, files.where(F.col("feed") == feed), cells, run_at)
        new = self.tables.read("ingest_batches", since=before + 1)
        self._new = self.spark.createDataFrame([], BATCHES) if new is None else new.drop("gen")
        return self._new

    def results(self) -> DataFrame:
        """What came of each file that the last run found. Files whose content was ingested before, or that
        repeat another file of the run, are ``skipped``; they leave no batch behind."""
        none = F.lit(0).cast("bigint")
        counts = ["rows_received", "rows_loaded", "rows_quarantined", "rows_resolved"]
        same = ["tenant_id", "feed", "source_file", "file_sha256"]
        skipped = self._skipped.select(*same, *[none.alias(c) for c in counts], F.lit("skipped").alias("status"))
        return self._new.select(*same, *counts, "status").unionByName(skipped)

    def _batches_of(self, files: DataFrame, run_at: dt.datetime) -> DataFrame:
        # Files of a tenant's feed load oldest first; a microsecond apart keeps them in order.
        nth = F.row_number().over(
            Window.partitionBy("tenant_id", "feed").orderBy("modified_at", "source_file")
        )
        later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (nth / 1e6).cast("decimal(18,6)"))
        return (
            files.withColumn("batch_id", F.md5(F.concat_ws("|", "tenant_id", "feed", "file_sha256")))
            .withColumn("loaded_at", ntz(run_at) + later)
            .join(self.config.select("tenant_id", "feed", "contract"), ["tenant_id", "feed"])
        )

    def _scan(
        self, fmt: SourceFormat, files: DataFrame, cells: DataFrame | None
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """What cannot be read is reported for its own files and holds up no other tenant's."""
        paths = [r["path"] for r in files.select("path").toLocalIterator()]
        if fmt.type == "csv":
            return read_delimited(self.spark, paths, fmt)
        if fmt.type != "excel":
            return unusable(self.spark, paths, f"we can't read files of type {fmt.type!r}")
        if cells is None:
            return unusable(self.spark, paths, "the workbook's cells didn't arrive with it")
        mine = cells.join(files, same_path(cells["file_path"], files["path"]), "left_semi")
        return read_cells(mine, fmt)

    def _ingest_feed(
        self,
        feed: str,
        tenants: list[Tenant],
        files: DataFrame,
        cells: DataFrame | None,
        run_at: dt.datetime,
    ) -> None:
        rows, layouts, errors = [], [], []
        by_format: dict[SourceFormat, list[str]] = {}
        for t in tenants:
            by_format.setdefault(t.feeds[feed].format, []).append(t.tenant_id)
        for fmt, ids in by_format.items():
            theirs = files.where(F.col("tenant_id").isin(ids))
            records, headers, bad = self._scan(fmt, theirs, cells)
            layout = staged(file_layouts(theirs, headers, self.config), "layouts")
            layouts.append(layout)
            errors.append(bad)
            rows.append(map_columns(records, layout))
        mapped = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
        layout = reduce(DataFrame.unionByName, layouts)

        gen = self.tables.begin()
        accepted, held, checked, broken = [], [], {}, []
        for ref in sorted({t.feeds[feed].contract for t in tenants}):
            contract = self.registry.get(ref)
            pinned = F.col("contract") == ref
            # Parsed once, then read by the duplicate and reference joins; their result is read by
            # everything the step writes.
            done = validate(mapped.where(pinned), contract, self.profiles, self._statuses(contract), _keep)
            checked[ref] = done = _keep(done)
            accepted.append(self._accepted(done, contract))
            held.append(self._rejected(done))
            broken.append(
                layout.where(pinned).select(
                    "batch_id", "unmapped_columns", missing_columns(contract).alias("file_violations")
                )
            )
        # One folder a tenant: who reads one tenant's rows opens no other's files.
        self.tables.write(f"raw_{feed}", gen, _union(accepted, "", self.spark), ["tenant_id"])
        self.tables.write("quarantine", gen, _union(held, QUARANTINE, self.spark), ["tenant_id"])
        raw = self.tables.written(f"raw_{feed}", gen, raw_schema(self.registry.latest(feed)))
        now_held = self.tables.written("quarantine", gen, QUARANTINE)
        self._resolve(feed, gen, raw, now_held)
        self._index(feed, gen, raw)

        bad = reduce(DataFrame.unionByName, errors)
        per_file = reduce(DataFrame.unionByName, broken)
        batches = self._audit(feed, gen, files, raw, now_held, per_file, bad, run_at)
        self.tables.write("ingest_batches", gen, batches)
        if self.reports is not None:
            self._report(feed, gen, tenants, checked, self.tables.written("ingest_batches", gen))
        self.tables.commit(gen, utc_now(), note=f"{feed} {run_at.isoformat()}")

    def _statuses(self, contract: Contract) -> dict[str, DataFrame]:
        if not contract.references:
            return {}
        waiting = q.open_rows(self._held(), self._closed())
        return {
            f.name: reference_status(self.known(*f.references), q.held_keys(waiting, f.references[0]))
            for f in contract.references
        }

    def known(self, feed: str, field: str) -> DataFrame:
        """Index of the keys of a feed that other feeds refer to: every value that was ever loaded."""
        return self._read(f"keys_{feed}_{field}", q.INDEX)

    def _index(self, feed: str, gen: int, raw: DataFrame) -> None:
        """Add the keys of a step's rows; they become visible with the rows, by the same commit."""
        every = [c for other in self.registry.feeds for c in self.registry.versions(other)]
        for field in sorted({f.references[1] for c in every for f in c.references if f.references[0] == feed}):
            self.tables.write(f"keys_{feed}_{field}", gen, q.new_keys(raw, field, self.known(feed, field)))

    def _accepted(self, done: DataFrame, contract: Contract) -> DataFrame:
        flat = done.where(is_accepted()).select(
            "tenant_id",
            *[F.col(f"record.{n}").alias(n) for n in contract.fields],
            F.col("batch_id").alias("_batch_id"),
            F.col("source_file").alias("_source_file"),
            F.col("source_row").alias("_source_row"),
            F.lit(contract.version).alias("_contract_version"),
            F.col("loaded_at").alias("_loaded_at"),
        )
        return upgrade(flat, contract, self.registry)

    @staticmethod
    def _rejected(done: DataFrame) -> DataFrame:
        whole = F.size("file_violations") > 0
        why = F.when(whole, F.col("file_violations")).otherwise(F.col("violations"))
        keep_nulls = {"ignoreNullFields": "false"}
        return done.where(~is_accepted()).select(
            "batch_id",
            "tenant_id",
            "feed",
            "source_file",
            "source_row",
            "record_key",
            F.to_json("raw", keep_nulls).alias("record"),
            F.to_json(why, keep_nulls).alias("violations"),
            F.col("loaded_at").alias("quarantined_at"),
        )

    def _resolve(self, feed: str, gen: int, raw: DataFrame, now_held: DataFrame) -> None:
        """Close what this step's rows resolve: rows open from earlier steps, and rows an earlier
        file of this step held back."""
        key = self.registry.latest(feed).primary_key
        loaded = raw.select(
            "tenant_id",
            F.lit(feed).alias("feed"),
            record_key(*key).alias("record_key"),
            F.col("_batch_id").alias("batch_id"),
            F.col("_loaded_at").alias("loaded_at"),
        )
        earlier = q.open_rows(self._held().where(F.col("feed") == feed), self._closed())
        columns = ["tenant_id", "feed", "record_key", "batch_id", "source_row", "quarantined_at"]
        waiting = earlier.select(*columns).unionByName(now_held.select(*columns))
        self.tables.write("resolutions", gen, q.resolutions(waiting, loaded, _keep))

    def _audit(
        self,
        feed: str,
        gen: int,
        files: DataFrame,
        raw: DataFrame,
        held: DataFrame,
        per_file: DataFrame,
        errors: DataFrame,
        run_at: dt.datetime,
    ) -> DataFrame:
        n = F.count(F.lit(1))
        loaded = raw.groupBy(F.col("_batch_id").alias("batch_id")).agg(n.alias("rows_loaded"))
        kept_back = held.groupBy("batch_id").agg(n.alias("rows_quarantined"))
        closed = self.tables.written("resolutions", gen)
        closed = closed.groupBy(F.col("resolved_batch_id").alias("batch_id")).agg(n.alias("rows_resolved"))
        bad = errors.withColumnRenamed("path", "bad_path")
        out = files.join(bad, same_path(files["path"], bad["bad_path"]), "left")
        for part in (per_file, loaded, kept_back, closed):
            out = out.join(part, "batch_id", "left")
        out = out.fillna(0, ["rows_loaded", "rows_quarantined", "rows_resolved"])
        rejected = F.col("message").isNotNull() | (F.coalesce(F.size("file_violations"), F.lit(0)) > 0)
        status = batch_status(rejected, F.col("rows_quarantined"))
        unmapped = F.coalesce("unmapped_columns", F.array().cast("array<string>"))
        wants_report = (status != "loaded") | (F.size(unmapped) > 0)
        # The folder that _report writes for the batch, under the folder of reports.
        folder = F.concat(F.lit(f"{feed}/gen={gen}/batches/tenant_id="), "tenant_id", F.lit("/batch_id="), "batch_id")
        report = F.when(F.lit(self.reports is not None) & wants_report, folder)
        file_violations = F.when(
            F.col("message").isNotNull(), unreadable(F.col("message"))
        ).otherwise(F.coalesce("file_violations", F.array().cast(f"array<{VIOLATION}>")))
        return out.select(
            "batch_id",
            "tenant_id",
            "feed",
            "contract",
            "source_file",
            "file_sha256",
            (F.col("rows_loaded") + F.col("rows_quarantined")).alias("rows_received"),
            "rows_loaded",
            "rows_quarantined",
            status.alias("status"),
            ntz(run_at).alias("started_at"),
            F.col("loaded_at").alias("finished_at"),
            report.alias("report_path"),
            "rows_resolved",
            unmapped.alias("unmapped_columns"),
            file_violations.alias("file_violations"),
        )

    def _report(
        self, feed: str, gen: int, tenants: list[Tenant], checked: dict[str, DataFrame], batches: DataFrame
    ) -> None:
        """Per-step report data: batch summaries, problem groups, and the rows to fix of all tenants, one
        write a contract version. A repeated step overwrites what it left."""
        wanted = needs_report(batches)
        where = f"{self.reports}/{feed}/gen={gen}"
        # A file a batch, written side by side however small they are.
        spread = wanted.repartition(self.spark.sparkContext.defaultParallelism, "batch_id")
        spread.write.mode("overwrite").partitionBy("tenant_id", "batch_id").json(f"{where}/batches")
        columns = ["tenant_id", "batch_id", "source_row", "violations"]
        rejected = [df.where(F.size("violations") > 0).select(*columns) for df in checked.values()]
        groups = violation_groups(reduce(DataFrame.unionByName, rejected))
        groups.write.mode("overwrite").json(f"{where}/problems")
        for ref, rows in checked.items():
            contract = self.registry.get(ref)
            labels = {t.tenant_id: t.feeds[feed].labels for t in tenants if t.feeds[feed].contract == ref}
            lists = listings(rows.where(F.size("violations") > 0), contract, labels)
            write_listings(lists, f"{where}/rows_to_fix/version={contract.version}")
