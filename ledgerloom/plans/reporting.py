"""Daily reports and the open work-order backlog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeutil import boundaries_between, ntz


def rpt_maintenance_daily(
    fct_events: DataFrame,
    touched_days: DataFrame | None = None,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Activity per tenant, local day and building. Events without a building form their own
    group. ``touched_days`` (tenant_id, event_date_local) limits the work to reopened days."""
    events = fct_events
    if touched_days is not None:
        events = events.join(
            touched_days.select("tenant_id", "event_date_local"),
            ["tenant_id", "event_date_local"],
            "left_semi",
        )
    opened = F.col("event_action") == "opened"
    daily = events.groupBy(
        "tenant_id", F.col("event_date_local").alias("activity_date"), "building_key"
    ).agg(
        F.count_if(opened).alias("work_orders_opened"),
        F.count_if(F.col("event_action") == "completed").alias("work_orders_completed"),
        F.count_if(opened & (F.col("priority") == "urgent")).alias("urgent_opened"),
        F.coalesce(F.sum("labor_minutes"), F.lit(0)).alias("labor_minutes"),
        F.coalesce(F.sum("parts_cost"), F.lit(0)).alias("parts_cost"),
        F.count_if("is_late_arrival").alias("late_events"),
    )
    return daily if run_ts is None else daily.withColumn("_refreshed_at", ntz(run_ts))


def rpt_commissary_daily(sales: DataFrame) -> DataFrame:
    """Store revenue per tenant, local day and category.

    Lines are first folded per transaction, so a hot (tenant, day, category) reaches the second
    aggregation already reduced on the map side.
    """
    amount = F.col("line_amount")
    on_account = F.when(F.col("payment_method") == "camper_account", amount).otherwise(F.lit(0))
    return sales.groupBy("tenant_id", "sold_date_local", "item_category").agg(
        F.count_distinct("transaction_id").alias("transactions"),
        F.sum("quantity").alias("units"),
        F.sum(amount).alias("revenue"),
        F.sum(on_account).alias("camper_account_revenue"),
    )


def rpt_work_order_backlog(work_orders: DataFrame, buildings: DataFrame) -> DataFrame:
    waiting = work_orders.where(F.col("status") != "completed")
    names = buildings.select("building_key", "building_name", "building_type")
    return waiting.join(names, "building_key", "left").select(
        "tenant_id",
        "work_order_id",
        "status",
        "priority",
        "category",
        "building_name",
        "building_type",
        "opened_at",
        boundaries_between("hour", "opened_at", "last_event_at").alias("hours_open_at_last_activity"),
        "is_missing_open_event",
    )
