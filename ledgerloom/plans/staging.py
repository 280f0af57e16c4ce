"""Typed, renamed views over the raw layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import latest_per_key

PAYLOAD_TEXT = (
    "work_order_id check_id building_code asset_tag staff_code reported_by category priority"
).split()
PAYLOAD_NUMERIC = "parts_cost chlorine_ppm ph water_temp_f".split()
PAYLOAD_INTEGER = ["labor_minutes"]
NUMERIC = "decimal(28,6)"
_PAYLOAD_SCHEMA = ", ".join(
    f"{name} string" for name in [*PAYLOAD_TEXT, *PAYLOAD_INTEGER, *PAYLOAD_NUMERIC]
)


_CORRUPT = "_corrupt_record"


def _payload(extra: str = "") -> Column:
    # Every field is read as text: numbers keep the digits the device sent (12.10, 1E3) and
    # one unreadable field cannot blank its neighbours.
    return F.from_json("payload", _PAYLOAD_SCHEMA + extra)


def _number(name: str) -> Column:
    return F.col(f"p.{name}").try_cast(NUMERIC)


def _integer(name: str) -> Column:
    number = _number(name)
    return F.when(number == F.floor(number), number.try_cast("int"))


def stg_app_events(raw: DataFrame) -> DataFrame:
    """One row per uploaded copy, payload typed, device clock clamped to the upload time."""
    return raw.withColumn("p", _payload()).select(
        "event_id",
        "tenant_id",
        "device_id",
        "device_seq",
        "event_type",
        F.split_part("event_type", F.lit("."), F.lit(1)).alias("event_entity"),
        F.split_part("event_type", F.lit("."), F.lit(2)).alias("event_action"),
        F.col("occurred_at").alias("device_occurred_at"),
        "received_at",
        F.least("occurred_at", "received_at").alias("event_at"),
        (F.col("occurred_at") > F.col("received_at")).alias("is_clock_corrected"),
        "upload_id",
        "p.work_order_id",
        "p.check_id",
        "p.building_code",
        "p.asset_tag",
        "p.staff_code",
        F.col("p.reported_by").alias("reported_by_staff_code"),
        "p.category",
        "p.priority",
        _integer("labor_minutes").alias("labor_minutes"),
        *[_number(n).alias(n) for n in PAYLOAD_NUMERIC],
    )


def payload_rejects(raw: DataFrame) -> DataFrame:
    """Copies whose payload, or a number in it, nobody can read. They still load, with that
    field null; this is the side output that says so."""
    bad = F.filter(
        F.array(
            F.when(F.col(f"p.{_CORRUPT}").isNotNull(), F.lit("payload")),
            *[
                F.when(F.col(f"p.{n}").isNotNull() & read(n).isNull(), F.lit(n))
                for names, read in ((PAYLOAD_INTEGER, _integer), (PAYLOAD_NUMERIC, _number))
                for n in names
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return (
        raw.withColumn("p", _payload(f", {_CORRUPT} string"))
        .withColumn("unreadable_fields", bad)
        .where(F.size("unreadable_fields") > 0)
        .drop("p")
    )


def stg_buildings(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["building_code"]).select(
        "tenant_id",
        "building_code",
        "building_name",
        "building_type",
        "capacity",
        "year_built",
        F.col("_contract_version").alias("contract_version"),
        F.col("_loaded_at").alias("loaded_at"),
    )


def stg_assets(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["asset_tag"]).select(
        "tenant_id",
        "asset_tag",
        "asset_name",
        F.col("category").alias("asset_category"),
        "building_code",
        "purchased_on",
        "purchase_cost",
        F.col("status").alias("asset_status"),
        F.col("_contract_version").alias("contract_version"),
        F.col("_loaded_at").alias("loaded_at"),
    )


def stg_staff(raw: DataFrame) -> DataFrame:
    return latest_per_key(raw, ["staff_code"]).select(
        "tenant_id",
        "staff_code",
        "first_name",
        "last_name",
        F.col("role").alias("staff_role"),
        "email",
        "start_date",
        "is_active",
        F.col("_loaded_at").alias("loaded_at"),
    )


def stg_commissary_transactions(raw: DataFrame) -> DataFrame:
    """Weekly exports overlap, so a sale line can arrive several times."""
    return latest_per_key(raw, ["transaction_id", "line_number"]).select(
        "tenant_id",
        "transaction_id",
        "line_number",
        "sold_at",
        "store_building_code",
        "cashier_staff_code",
        "sku",
        "item_name",
        "item_category",
        "quantity",
        "unit_price",
        "payment_method",
        F.col("_loaded_at").alias("loaded_at"),
    )


def stg_ingest_batches(batches: DataFrame) -> DataFrame:
    return batches.select(
        "batch_id",
        "tenant_id",
        "feed",
        "contract",
        "source_file",
        F.col("status").alias("batch_status"),
        "rows_received",
        "rows_loaded",
        "rows_quarantined",
        "started_at",
        "finished_at",
        "report_path",
    )


def stg_quarantine(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(
        "batch_id",
        "tenant_id",
        "feed",
        "source_file",
        "source_row",
        "record_key",
        "quarantined_at",
        "resolved_batch_id",
        "resolved_at",
        F.col("resolved_batch_id").isNotNull().alias("is_resolved"),
    )
