"""Event-grain facts, the accumulating work-order snapshot and sale lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import nullable_key, surrogate_key
from ..functions.timeutil import boundaries_between, local_date
from .events import work_order_events

LATE_MINUTES = 60

# Lifecycle action -> status; anything else is an open order.
STATUS_OF_ACTION = {"completed": "completed", "started": "in_progress", "assigned": "assigned"}


def _zones(tenants: DataFrame) -> DataFrame:
    return tenants.select("tenant_id", "timezone")


def _optional(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def fct_maintenance_events(
    events: DataFrame, tenants: DataFrame, late_minutes: int = LATE_MINUTES
) -> DataFrame:
    """One row per work-order event, dated by when it happened in the tenant's own zone."""
    located = work_order_events(events).join(_zones(tenants), "tenant_id")
    lag = F.col("arrival_lag_minutes")
    return located.select(
        "event_id",
        "tenant_id",
        surrogate_key("tenant_id", "work_order_id").alias("work_order_key"),
        "work_order_id",
        "event_action",
        "event_at",
        local_date("event_at", "timezone").alias("event_date_local"),
        nullable_key("tenant_id", "building_code").alias("building_key"),
        nullable_key("tenant_id", "asset_tag").alias("asset_key"),
        nullable_key("tenant_id", F.coalesce("staff_code", "reported_by_staff_code")).alias("staff_key"),
        "category",
        "priority",
        "labor_minutes",
        "parts_cost",
        "device_id",
        "device_seq",
        "received_at",
        "arrival_lag_minutes",
        (lag > late_minutes).alias("is_late_arrival"),
        "is_clock_corrected",
        *_optional(events, "_loaded_at"),
    )


def fct_work_orders(fct_events: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """One row per work order, always derived from all of its events, so arrival order is
    irrelevant. Milestones and latest status come out of one partially aggregated shuffle."""
    events = fct_events
    if touched is not None:
        events = events.join(touched.select("work_order_key"), "work_order_key", "left_semi")

    def on(action: str, column: str) -> Column:
        return F.when(F.col("event_action") == action, F.col(column))

    extra = [F.max("_loaded_at").alias("_loaded_at")] if "_loaded_at" in fct_events.columns else []
    orders = events.groupBy("work_order_key").agg(
        F.min("tenant_id").alias("tenant_id"),
        F.min("work_order_id").alias("work_order_id"),
        F.max(on("opened", "building_key")).alias("building_key"),
        F.max(on("opened", "asset_key")).alias("asset_key"),
        F.max(on("opened", "category")).alias("category"),
        F.max(on("opened", "priority")).alias("priority"),
        F.max(on("opened", "staff_key")).alias("reported_by_staff_key"),
        F.max(on("assigned", "staff_key")).alias("assigned_staff_key"),
        F.max_by("event_action", F.struct("event_at", "device_seq", "event_id")).alias("latest_action"),
        F.min(on("opened", "event_at")).alias("opened_at"),
        F.min(on("assigned", "event_at")).alias("assigned_at"),
        F.min(on("started", "event_at")).alias("started_at"),
        F.max(on("completed", "event_at")).alias("completed_at"),
        F.sum("labor_minutes").alias("labor_minutes"),
        F.sum("parts_cost").alias("parts_cost"),
        F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("is_late_arrival")).alias("late_event_count"),
        F.max("event_at").alias("last_event_at"),
        *extra,
    )
    status = F.lit("open")
    for action, name in STATUS_OF_ACTION.items():
        status = F.when(F.col("latest_action") == action, name).otherwise(status)
    return orders.select(
        "work_order_key",
        "tenant_id",
        "work_order_id",
        "building_key",
        "asset_key",
        "category",
        "priority",
        "reported_by_staff_key",
        "assigned_staff_key",
        status.alias("status"),
        "opened_at",
        "assigned_at",
        "started_at",
        "completed_at",
        boundaries_between("minute", "opened_at", "assigned_at").alias("minutes_to_assign"),
        boundaries_between("minute", "opened_at", "completed_at").alias("minutes_to_complete"),
        "labor_minutes",
        "parts_cost",
        "event_count",
        "late_event_count",
        F.col("opened_at").isNull().alias("is_missing_open_event"),
        "last_event_at",
        *_optional(orders, "_loaded_at"),
    )


def water_out_of_range(chlorine: Column, ph: Column) -> Column:
    """Pools: 1 to 4 ppm free chlorine and pH 7.2 to 7.8. Open water: pH 6.5 to 9.0."""
    pool = (chlorine < 1.0) | (chlorine > 4.0) | (ph < 7.2) | (ph > 7.8)
    return F.when(chlorine.isNotNull(), pool).otherwise((ph < 6.5) | (ph > 9.0))


def fct_waterfront_checks(events: DataFrame, tenants: DataFrame) -> DataFrame:
    checks = events.where(F.col("event_type") == "waterfront.check_logged")
    chlorine = F.col("chlorine_ppm")
    return checks.join(_zones(tenants), "tenant_id").select(
        "event_id",
        "tenant_id",
        "check_id",
        surrogate_key("tenant_id", "building_code").alias("building_key"),
        surrogate_key("tenant_id", "staff_code").alias("staff_key"),
        F.col("event_at").alias("checked_at"),
        local_date("event_at", "timezone").alias("checked_date_local"),
        "chlorine_ppm",
        "ph",
        "water_temp_f",
        chlorine.isNotNull().alias("is_pool"),
        water_out_of_range(chlorine, F.col("ph")).alias("is_out_of_range"),
        "device_id",
        "arrival_lag_minutes",
        *_optional(events, "_loaded_at"),
    )


def fct_commissary_sales(sales: DataFrame, tenants: DataFrame) -> DataFrame:
    return sales.join(_zones(tenants), "tenant_id").select(
        surrogate_key("tenant_id", "transaction_id", "line_number").alias("sale_line_key"),
        "tenant_id",
        "transaction_id",
        "line_number",
        "sold_at",
        local_date("sold_at", "timezone").alias("sold_date_local"),
        surrogate_key("tenant_id", "store_building_code").alias("building_key"),
        nullable_key("tenant_id", "cashier_staff_code").alias("staff_key"),
        "sku",
        "item_name",
        "item_category",
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("line_amount"),
        "payment_method",
    )
