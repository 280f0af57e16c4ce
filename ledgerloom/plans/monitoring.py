"""How data is arriving: device delivery, onboarding quality, freshness, run summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import ntz
from .facts import LATE_MINUTES


def mon_event_delivery(
    stg: DataFrame, events: DataFrame, late_minutes: int = LATE_MINUTES
) -> DataFrame:
    """Copies, new events, duplicates and lateness per tenant, device and UTC received day.

    Every event has exactly one winning copy and ``events`` holds it, on the winner's own grain.
    So duplicates are copies minus winners, and nothing has to be numbered inside an event: both
    inputs go through one partially aggregated shuffle.
    """
    none = F.lit(None)
    copies = stg.select(
        "tenant_id",
        "device_id",
        F.col("received_at").cast("date").alias("received_date"),
        F.lit(False).alias("kept"),
        none.cast("bigint").alias("lag"),
        none.cast("boolean").alias("corrected"),
    )
    kept = events.select(
        "tenant_id",
        "device_id",
        F.col("received_at").cast("date").alias("received_date"),
        F.lit(True).alias("kept"),
        F.col("arrival_lag_minutes").alias("lag"),
        F.col("is_clock_corrected").alias("corrected"),
    )
    totals = (
        copies.unionByName(kept)
        .groupBy("tenant_id", "device_id", "received_date")
        .agg(
            F.count_if(~F.col("kept")).alias("copies_uploaded"),
            F.count_if("kept").alias("new_events"),
            F.count_if(F.col("lag") > late_minutes).alias("late_events"),
            F.max("lag").alias("max_arrival_lag_minutes"),
            F.count_if("corrected").alias("clock_corrections"),
        )
        .where(F.col("copies_uploaded") > 0)
    )
    return totals.select(
        "tenant_id",
        "device_id",
        "received_date",
        "copies_uploaded",
        "new_events",
        (F.col("copies_uploaded") - F.col("new_events")).alias("duplicate_copies"),
        "late_events",
        "max_arrival_lag_minutes",
        "clock_corrections",
    )


def mon_ingestion_quality(
    batches: DataFrame, quarantine: DataFrame, tenants: DataFrame
) -> DataFrame:
    """What each tenant sent per feed, what loaded, and what still waits on them.

    ``batches`` and ``quarantine`` are the staging views of the audit tables.
    """
    sent = batches.groupBy("tenant_id", "feed").agg(
        F.count(F.lit(1)).alias("batches"),
        F.count_if(F.col("batch_status") == "rejected").alias("files_rejected"),
        F.sum("rows_received").alias("rows_received"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_quarantined").alias("rows_quarantined"),
        F.max("finished_at").alias("last_batch_at"),
    )
    is_open = ~F.col("is_resolved")
    held = quarantine.groupBy("tenant_id", "feed").agg(
        F.count_if("is_resolved").alias("rows_resolved"),
        F.count_if(is_open).alias("rows_open"),
        F.min(F.when(is_open, F.col("quarantined_at"))).alias("oldest_open_since"),
    )
    return (
        sent.join(tenants.select("tenant_id", "camp_name"), "tenant_id")
        .join(held, ["tenant_id", "feed"], "left")
        .select(
            "tenant_id",
            "camp_name",
            "feed",
            "batches",
            "files_rejected",
            "rows_received",
            "rows_loaded",
            "rows_quarantined",
            F.coalesce("rows_resolved", F.lit(0)).alias("rows_resolved"),
            F.coalesce("rows_open", F.lit(0)).alias("rows_open"),
            "oldest_open_since",
            "last_batch_at",
        )
    )


def ingestion_status(quality: DataFrame) -> DataFrame:
    """The operator's status listing, ordered by camp and feed."""
    return quality.select(
        "camp_name",
        "feed",
        "batches",
        "files_rejected",
        "rows_loaded",
        "rows_quarantined",
        "rows_resolved",
        "rows_open",
    ).orderBy("camp_name", "feed")


def source_freshness(raw_events: DataFrame, as_of: dt.datetime, warn_after_days: int = 2) -> DataFrame:
    """One row: newest upload and whether it is older than the limit. No uploads is stale too."""
    limit = F.make_dt_interval(F.lit(warn_after_days))
    return raw_events.agg(F.max("received_at").alias("max_received_at")).withColumn(
        "is_stale", F.coalesce(ntz(as_of) - F.col("max_received_at") > limit, F.lit(True))
    )


def run_summary(batches: DataFrame, resolved_rows: DataFrame) -> DataFrame:
    """Totals of one run. ``resolved_rows`` are the quarantined rows the run closed."""
    totals = batches.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum("rows_quarantined"), F.lit(0)).alias("rows_quarantined"),
        F.lit(0).cast("bigint").alias("rows_resolved"),
    )
    closed = resolved_rows.agg(F.count(F.lit(1)).alias("rows_resolved"))
    # Both sides hold one row; the sum keeps it a plain union instead of a cross join.
    zero = F.lit(0).cast("bigint")
    parts = totals.unionByName(
        closed.select(
            zero.alias("files"),
            zero.alias("rejected"),
            zero.alias("rows_loaded"),
            zero.alias("rows_quarantined"),
            "rows_resolved",
        )
    )
    return parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
