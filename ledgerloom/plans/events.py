"""Exactly-once events from at-least-once uploads (batch form).

The incremental form, which also handles a copy that was received earlier but lands later,
is in ``streaming.marts``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import boundaries_between, ntz
from ..operators.dedupe import first_copy

EVENT_COLUMNS = (
    "event_id tenant_id device_id device_seq event_type event_entity event_action "
    "device_occurred_at received_at event_at is_clock_corrected upload_id arrival_lag_minutes "
    "work_order_id check_id building_code asset_tag staff_code reported_by_staff_code category "
    "priority labor_minutes parts_cost chlorine_ppm ph water_temp_f"
).split()


def with_lag(copies: DataFrame) -> DataFrame:
    return copies.withColumn(
        "arrival_lag_minutes", boundaries_between("minute", "event_at", "received_at")
    )


def dedupe_events(
    stg: DataFrame, existing: DataFrame | None = None, run_ts: dt.datetime | None = None
) -> DataFrame:
    """One row per event id, first received copy wins.

    With ``existing`` the result holds only what a run has to add or replace: events not stored
    yet, and stored events for which an earlier-received copy has now landed.
    """
    winners = with_lag(first_copy(stg)).select(*EVENT_COLUMNS)
    if existing is not None:
        stored = existing.select(
            "event_id",
            F.col("received_at").alias("stored_received_at"),
            F.col("upload_id").alias("stored_upload_id"),
        )
        winners = (
            winners.join(stored, "event_id", "left")
            .where(
                F.col("stored_received_at").isNull()
                | (
                    F.struct("received_at", "upload_id")
                    < F.struct("stored_received_at", "stored_upload_id")
                )
            )
            .select(*EVENT_COLUMNS)
        )
    return winners if run_ts is None else winners.withColumn("_loaded_at", ntz(run_ts))


def since_lookback(stg: DataFrame, existing: DataFrame, lookback_days: int = 3) -> DataFrame:
    """Copies received no more than ``lookback_days`` before the latest stored one.

    A scan bound for scheduled runs that re-read the raw log. An empty target reads everything.
    The bound is one scalar, so it reaches the scan as a pushed-down literal filter.
    """
    high = existing.agg((F.max("received_at") - F.make_dt_interval(F.lit(lookback_days))).alias("h"))
    bound = high.first()["h"]
    return stg if bound is None else stg.where(F.col("received_at") >= ntz(bound))


def added_since(upstream: DataFrame, target: DataFrame | None, mark: str = "_loaded_at") -> DataFrame:
    """Rows a model has not seen: loaded after its own high-water mark. A target that is absent
    or empty has seen nothing."""
    high = None if target is None else target.agg(F.max(mark).alias("h")).first()["h"]
    return upstream if high is None else upstream.where(F.col("_loaded_at") > ntz(high))


def work_order_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_entity") == "work_order")
