"""Device uploads: JSON lines, one envelope per line."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import ntz

# Times are read as text: an ISO time may carry an offset, and is kept as the wall time it shows.
_EVENT = (
    "struct<event_id:string,device_id:string,device_seq:int,event_type:string,"
    "occurred_at:string,payload:string>"
)
UPLOAD_SCHEMA = (
    f"upload_id string, tenant_id string, device_id string, received_at string, events array<{_EVENT}>"
)
RAW_EVENT_COLUMNS = (
    "event_id tenant_id device_id device_seq event_type occurred_at received_at upload_id payload"
).split()


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(UPLOAD_SCHEMA).json(path)


def stream_uploads(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(UPLOAD_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def upload_rows(uploads: DataFrame) -> DataFrame:
    """One raw event row per uploaded event."""
    exploded = uploads.select("tenant_id", "received_at", "upload_id", F.explode("events").alias("e"))
    return exploded.select(
        "e.event_id",
        "tenant_id",
        "e.device_id",
        "e.device_seq",
        "e.event_type",
        F.col("e.occurred_at").cast("timestamp_ntz").alias("occurred_at"),
        F.col("received_at").cast("timestamp_ntz").alias("received_at"),
        "upload_id",
        "e.payload",
    )


def write_uploads(uploads: DataFrame, path: str) -> None:
    uploads.write.mode("overwrite").json(path)


def pending_uploads(
    uploads: DataFrame, landed: DataFrame | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """Uploads received up to ``until`` whose id has not landed yet.

    The anti join needs no distinct ids on the landed side: only upload_id is read.
    """
    due = uploads
    if until is not None:
        due = due.where(F.col("received_at").cast("timestamp_ntz") <= ntz(until))
    return due if landed is None else due.join(landed.select("upload_id"), "upload_id", "left_anti")
